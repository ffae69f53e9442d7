"""Arithmetic of sampled signals and sequences held in array columns."""

from __future__ import annotations

import io
import wave

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def strided_length(length: Column, kernel: int = 3, stride: int = 2, factor: int = 4, toward_zero: bool = False) -> Column:
    """Frames left after log2(factor) strided convolutions with half padding, in whole numbers.

    Lengths that padding does not fill (0 with a kernel of 3) divide down, or as SQL's whole division does ``toward_zero``.
    """
    steps = factor.bit_length() - 1
    length = length.cast("bigint")
    for _ in range(steps):
        room = length + (2 * (kernel // 2) - kernel)
        length = F.call_function("div", room if toward_zero else room - F.pmod(room, F.lit(stride)), F.lit(stride)) + 1
    return length.cast("bigint")


def pad(values: Column, length: int, fill: float = 0.0) -> Column:
    """An array cut or filled up to a length."""
    return F.slice(F.concat(values, F.array_repeat(F.lit(fill), length)), 1, length)


def mask_spans(values: Column, spans: Column, fill: float = 0.0) -> Column:
    """values with the positions in any of spans (array of struct(start, length)) set to fill."""
    return F.transform(values, lambda x, i: F.when(F.exists(spans, lambda s: (i >= s["start"]) & (i < s["start"] + s["length"])), fill).otherwise(x))


def seeded_spans(key: Column, n: int, length: Column, widest: float) -> Column:
    """n spans drawn from a digest of key, each up to a share of length wide; reruns agree."""
    draw = lambda i, salt: F.pmod(F.xxhash64(key, i, F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)
    width = lambda i: F.floor(draw(i, 1) * widest * length).cast("int")
    return F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.struct(F.floor(draw(i, 2) * (length - width(i))).cast("int").alias("start"), width(i).alias("length")))


def mixed_at(signal: Column, noise: Column, ratio_db: Column) -> Column:
    """signal plus noise at a ratio of powers in decibels; noise repeats to the signal's length."""
    power = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x) / F.greatest(F.size(a), F.lit(1))
    gain = F.sqrt(power(signal) / F.nullif(power(noise) * F.pow(F.lit(10.0), ratio_db / 10), F.lit(0.0)))
    return F.transform(signal, lambda x, i: x + F.coalesce(gain, F.lit(0.0)) * F.element_at(noise, (F.pmod(i, F.size(noise)) + 1).cast("int")))


def wave_header(content: Column) -> Column:
    """struct(rate, channels, seconds) of RIFF wave bytes; nulls where they do not read."""

    def run(content):
        out = []
        for raw in content:
            try:
                with wave.open(io.BytesIO(raw)) as w:
                    out.append((w.getframerate(), w.getnchannels(), w.getnframes() / w.getframerate()))
            except (wave.Error, EOFError, TypeError, ZeroDivisionError):
                out.append((None, None, None))
        return pd.DataFrame(out, columns=["rate", "channels", "seconds"]).astype({"rate": "Int32", "channels": "Int32", "seconds": "Float64"})

    return F.pandas_udf(run, "rate int, channels int, seconds double", F.PandasUDFType.SCALAR)(content)


def usable_duration(seconds: Column, least: float, most: float) -> Column:
    """Why a duration is refused; null if it is in the band."""
    return F.when(seconds.isNull() | F.isnan(seconds), "unknown").when(seconds < least, "too_short").when(seconds > most, "too_long")
