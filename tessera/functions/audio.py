"""Preparing audio: payloads, mixdown, resampling."""

from __future__ import annotations

import io
import wave

import numpy as np


def payload(audio: dict | None, where: str) -> tuple[np.ndarray, int]:
    """(samples, rate) of a decoded array or of WAV bytes; ValueError naming ``where`` otherwise."""
    if audio and audio.get("array") is not None:
        return np.asarray(audio["array"], np.float32), int(audio["sampling_rate"])
    if audio and audio.get("bytes") is not None:
        try:
            with wave.open(io.BytesIO(audio["bytes"])) as f:
                width, channels, rate = f.getsampwidth(), f.getnchannels(), f.getframerate()
                raw = f.readframes(f.getnframes())
        except (wave.Error, EOFError) as e:
            raise ValueError(f"audio can't be decoded at {where}: {e}") from e
        if width not in (2, 4):
            raise ValueError(f"unsupported sample width {width} at {where}")
        kind, full = ((np.int16, 1 << 15), (np.int32, 1 << 31))[width == 4]
        return (np.frombuffer(raw, kind).astype(np.float32) / full).reshape(-1, channels).T, rate
    raise ValueError(f"no audio payload at {where}")


def mixdown(x: np.ndarray) -> np.ndarray:
    """One channel: of [channels, samples], or of [samples, channels] with at most eight channels."""
    x = np.asarray(x, np.float32)
    if x.ndim == 1:
        return x
    if x.ndim != 2:
        raise ValueError(f"audio of rank {x.ndim}")
    if x.shape[0] > x.shape[1] and x.shape[1] <= 8:
        x = x.T
    return x.mean(0)


def resample(x: np.ndarray, rate: int, to: int) -> np.ndarray:
    """Linear interpolation to ceil(n * to / rate) samples; a stand-in, not identical to a sinc resampler."""
    if rate == to or not len(x):
        return x
    n = -(-len(x) * to // rate)
    return np.interp(np.arange(n) * (rate / to), np.arange(len(x)), x).astype(np.float32)


def prepare(audio: dict | None, where: str, model_rate: int = 24_000) -> dict:
    """samples, source_num_samples, source_sample_rate, audio_seconds, model_num_samples."""
    x, rate = payload(audio, where)
    x = mixdown(x)
    if rate <= 0 or not len(x):
        raise ValueError(f"empty audio at {where}")
    y = resample(x, rate, model_rate)
    return {"samples": y, "source_num_samples": len(x), "source_sample_rate": rate, "audio_seconds": len(x) / rate, "model_num_samples": len(y)}
