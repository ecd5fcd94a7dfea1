"""Sample count and duration from a canonical PCM WAV header, no UDF.

Little-endian integers are assembled byte by byte: each byte is hex-encoded on
its own and the hex digits concatenated high byte first, then ``conv`` turns
them into a number. ``reverse`` on the binary would treat it as UTF-8 text and
is wrong for multi-byte sequences, so it is not used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed canonical-header layout (1-based byte offsets).
RIFF_AT, WAVE_AT, FMT_AT, DATA_TAG_AT = 1, 9, 13, 37
CHANNELS_AT, RATE_AT, BITS_AT, DATA_SIZE_AT = 23, 25, 35, 41


def _le_uint(content: Column, pos: int, nbytes: int) -> Column:
    hexes = [F.lpad(F.hex(F.substring(content, pos + i, 1)), 2, "0") for i in reversed(range(nbytes))]
    return F.conv(F.concat(*hexes), 16, 10).cast("bigint")


def wav_profile(content: Column | str) -> list[Column]:
    """channels, sampling_rate, bits_per_sample, data_bytes, n_samples, duration_s.

    A header that is not the canonical 44-byte RIFF/WAVE/fmt/data layout gives nulls.
    """
    c = F.col(content) if isinstance(content, str) else content
    canonical = ((F.substring(c, RIFF_AT, 4) == F.lit(b"RIFF"))
                 & (F.substring(c, WAVE_AT, 4) == F.lit(b"WAVE"))
                 & (F.substring(c, FMT_AT, 4) == F.lit(b"fmt "))
                 & (F.substring(c, DATA_TAG_AT, 4) == F.lit(b"data")))
    ch = _le_uint(c, CHANNELS_AT, 2)
    rate = _le_uint(c, RATE_AT, 4)
    bits = _le_uint(c, BITS_AT, 2)
    data = _le_uint(c, DATA_SIZE_AT, 4)
    frame_bytes = ch * (bits / F.lit(8))
    n = F.when(frame_bytes > 0, (data / frame_bytes).cast("bigint"))
    dur = F.try_divide(n, rate)

    def g(x: Column, name: str) -> Column:
        return F.when(canonical, x).alias(name)

    return [g(ch, "channels"), g(rate, "sampling_rate"), g(bits, "bits_per_sample"),
            g(data, "data_bytes"), g(n, "n_samples"), g(dur, "duration_s")]
