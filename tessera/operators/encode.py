"""The encoder plug-in: batches in, code lists out; a deterministic stand-in; search and equivalence checks."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Protocol

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import CODEBOOK, SAMPLE_RATE, frame_size


class Encoder(Protocol):
    """May also have ``memory_fraction()``, the peak share of device memory since the last call."""

    sample_rate: int
    identity: str

    def encode(self, audio: Sequence[np.ndarray]) -> np.ndarray:
        """[batch, codebook, frame] for waveforms padded to the longest."""


class HashEncoder:
    """Codes from frame energy; a stand-in for a neural codec, with which it shares only its shapes."""

    sample_rate = SAMPLE_RATE

    def __init__(self, codebooks: int = 2):
        self.codebooks = codebooks
        self.identity = hashlib.sha256(f"hash-encoder-{codebooks}".encode()).hexdigest()

    def encode(self, audio: Sequence[np.ndarray]) -> np.ndarray:
        size = frame_size(self.sample_rate)
        frames = max(-(-len(a) // size) for a in audio)
        out = np.zeros((len(audio), self.codebooks, frames), np.int64)
        for i, a in enumerate(audio):
            x = np.zeros(frames * size)
            x[: len(a)] = a
            level = np.abs(x.reshape(frames, size)).mean(1)
            for k in range(self.codebooks):
                out[i, k] = (np.floor(level * 4096 * (k + 1)).astype(np.int64) + np.arange(frames) * 17) % CODEBOOK
        return out


def is_out_of_memory(e: BaseException) -> bool:
    text = str(e).lower()
    return type(e).__name__ == "OutOfMemoryError" or ("cuda" in text and "out of memory" in text)


def encode_batch(encoder: Encoder, audio: list[np.ndarray], codebook: int = 0) -> list[list[int]]:
    """Codes of one codebook, trimmed to each waveform's own frames."""
    if not audio:
        return []
    codes = np.asarray(encoder.encode(audio))
    if codes.ndim != 3:
        raise ValueError(f"codes of rank {codes.ndim}")
    if not 0 <= codebook < codes.shape[1]:
        raise ValueError(f"codebook {codebook} is out of range")
    size = frame_size(encoder.sample_rate)
    return [codes[i, codebook, : -(-len(a) // size)].astype(np.int32).tolist() for i, a in enumerate(audio)]


def encode_with_backoff(encoder: Encoder, audio: list[np.ndarray], budget: float, codebook: int = 0) -> tuple[list[list[int]], float]:
    """Halve a batch that exhausts memory, keep its order, and report the smallest budget that worked."""
    try:
        return encode_batch(encoder, audio, codebook), budget
    except Exception as e:
        if not is_out_of_memory(e) or len(audio) == 1:
            raise
    half = len(audio) // 2
    left, b1 = encode_with_backoff(encoder, audio[:half], budget / 2, codebook)
    right, b2 = encode_with_backoff(encoder, audio[half:], budget / 2, codebook)
    return left + right, min(b1, b2)


@dataclass
class Trial:
    budget_audio_seconds: float
    status: str
    examples: int | None = None
    actual_audio_seconds: float | None = None
    elapsed_seconds: float | None = None
    throughput_x_realtime: float | None = None
    gpu_memory_fraction: float | None = None


def search_budget(attempt: Callable[[float], Trial], low: float, high: float, target: float) -> tuple[float, list[Trial]]:
    """Double the budget while memory allows; the last one within the target is recommended."""
    trials, best, budget = [], None, low
    while budget <= high:
        try:
            t = attempt(budget)
        except Exception as e:
            if not is_out_of_memory(e):
                raise
            trials.append(Trial(budget, "oom"))
            break
        trials.append(t)
        if t.gpu_memory_fraction is None or t.gpu_memory_fraction <= target:
            best = budget
        if t.gpu_memory_fraction is not None and t.gpu_memory_fraction >= target:
            break
        budget *= 2
    if best is None:
        raise RuntimeError("no batch budget fits in memory")
    return best, trials


def proxy_codes(key: Column, length: Column, codebook: int = CODEBOOK) -> Column:
    """Stand-in codes as a column expression: (31 * key + 17 * i) mod codebook for i under length."""
    i = F.when(length > 0, F.sequence(F.lit(0), length.cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(i, lambda x: F.pmod(key * 31 + x.cast("bigint") * 17, F.lit(codebook)).cast("int"))


def unequal(single: DataFrame, batch: DataFrame, key: str, codes: str) -> DataFrame:
    """Keys whose two encodings differ, or that only one side has."""
    a, b = single.select(key, F.col(codes).alias("single_codes")), batch.select(key, F.col(codes).alias("batch_codes"))
    return a.join(b, key, "full").where(~F.col("single_codes").eqNullSafe(F.col("batch_codes")))
