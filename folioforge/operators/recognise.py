"""Models: ONNX sessions, one a Python worker, and what their logits mean. onnxruntime is optional."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

import numpy as np


def providers() -> list[str]:
    """What this machine's runtime can compute on, best first; none without a runtime."""
    try:
        import onnxruntime
    except ModuleNotFoundError:
        return []
    return onnxruntime.get_available_providers()


@cache
def session(path: str, on: tuple[str, ...] = ()):
    import onnxruntime

    return onnxruntime.InferenceSession(path, providers=list(on) or providers())


def onnx_runner(path: str, input_name: str, output_name: str, on: tuple[str, ...] = ()) -> Callable[[np.ndarray], np.ndarray]:
    """A model on the given providers, or on whatever the executor that runs it has."""

    def run(batch: np.ndarray) -> np.ndarray:
        return session(path, on).run([output_name], {input_name: batch})[0]

    return run


def describe(path: str) -> dict[str, list[tuple[str, str, tuple]]]:
    """Inputs and outputs of a model: (name, type, shape), a size that varies by its name."""
    s = session(path)
    return {kind: [(v.name, v.type, tuple(v.shape)) for v in values] for kind, values in (("inputs", s.get_inputs()), ("outputs", s.get_outputs()))}


def sigmoid_mask(logits: np.ndarray, threshold: float = 0.9) -> np.ndarray:
    return (1 / (1 + np.exp(-logits.astype(np.float64))) > threshold).astype(np.uint8)


def softmax_mask(logits: np.ndarray, channel: int, threshold: float = 0.8) -> np.ndarray:
    """(n, classes, h, w) -> mask of one class."""
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return ((e / e.sum(axis=1, keepdims=True))[:, channel] > threshold).astype(np.uint8)
