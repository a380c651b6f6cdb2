"""Batched calls of injected functions (models, embeddings) inside tasks."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

BatchFn = Callable[[list[str]], Sequence[object]]


def one_by_one(fn: Callable[[str], object]) -> BatchFn:
    """A batch function out of one for single texts; a failure belongs to its text."""

    def run(texts: list[str]) -> list[object]:
        out: list[object] = []
        for text in texts:
            try:
                out.append(fn(text))
            except Exception as exc:  # noqa: BLE001
                out.append(exc)
        return out

    return run


def call_batches(
    fn: BatchFn,
    texts: Sequence[str],
    batch_size: int = 32,
    concurrency: int = 4,
    retries: int = 0,
    again: Callable[[Exception], bool] = lambda exc: True,
    pause: float = 1.0,
) -> list[object]:
    """One result per text, an exception where there is none.

    At most ``concurrency`` calls of ``batch_size`` texts run at a time.  An
    element of a result may be an exception.  Texts whose exception is worth it
    are sent again, all of them after one pause; texts of a call that failed as
    a whole are sent again one by one.
    """
    results: list[object] = [None] * len(texts)

    def send(some: list[int]) -> list[tuple[int, object, bool]]:
        try:
            answers = list(fn([texts[i] for i in some]))
            if len(answers) != len(some):
                raise ValueError(f"{len(answers)} results for {len(some)} texts")
            return [(i, a, False) for i, a in zip(some, answers, strict=True)]
        except Exception as exc:  # noqa: BLE001
            return [(i, exc, len(some) > 1) for i in some]

    waiting = [list(range(i, min(i + batch_size, len(texts)))) for i in range(0, len(texts), batch_size)]
    attempt = 0
    with ThreadPoolExecutor(max_workers=concurrency) as pool:
        while waiting:
            alone, later = [], []
            for done in pool.map(send, waiting):
                for i, answer, whole in done:
                    results[i] = answer
                    if whole:
                        alone.append([i])
                    elif isinstance(answer, Exception) and again(answer):
                        later.append(i)
            waiting = alone
            if later and attempt < retries:
                time.sleep(pause * 2**attempt)
                attempt += 1
                waiting += [later[i : i + batch_size] for i in range(0, len(later), batch_size)]
    return results
