import struct

from pyspark.sql import functions as F

from utterflow.functions.wav import wav_profile


def header(channels, rate, bits, data_bytes):
    return (b"RIFF" + struct.pack("<I", 36 + data_bytes) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, channels, rate,
            rate * channels * bits // 8, channels * bits // 8, bits) + b"data" + struct.pack("<I", data_bytes))


def test_wav_header_profile(spark):
    cases = [(1, 8000, 16, 0xA9C3 * 2), (2, 16000, 16, 0xE282AC), (1, 22050, 8, 0xC3A900),
             (1, 44100, 16, 320000), (2, 48000, 16, 0)]
    df = spark.createDataFrame([(header(*c) + b"\x00" * 4,) for c in cases], "content binary")
    rows = df.select(*wav_profile("content")).collect()
    for (ch, rate, bits, data), r in zip(cases, rows):
        assert (r.channels, r.sampling_rate, r.bits_per_sample, r.data_bytes) == (ch, rate, bits, data)
        assert r.n_samples == data // (ch * bits // 8)


def test_wav_non_canonical_is_null(spark):
    df = spark.createDataFrame([(b"ID3\x00" * 20,), (b"RIFF",)], "content binary")
    rows = df.select(*wav_profile("content")).collect()
    assert all(v is None for r in rows for v in r)
