"""Driving an external batch annotator and a price source: pluggable clients, bounded concurrency, resumable.

Neither runs on executors; clients are injected, and deterministic stand-ins serve offline runs and tests.
"""

from __future__ import annotations

import json
import time
from collections import deque
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from pathlib import Path
from typing import Protocol

ENDED = {"completed", "failed", "expired", "cancelled"}


class BatchClient(Protocol):
    def submit(self, path: Path) -> str: ...

    def status(self, batch: str) -> str: ...

    def output(self, batch: str) -> list[str]: ...


class PriceSource(Protocol):
    def bars(self, symbols: Sequence[str], start: str, end: str) -> list[dict]: ...


class NoPrices:
    """A source without any bars, for runs without one."""

    def bars(self, symbols: Sequence[str], start: str, end: str) -> list[dict]:
        return []


@dataclass
class OfflineAnnotator:
    """Answers every request with one empty result per item; states pass through one pending step."""

    polls: dict[str, int] = field(default_factory=dict)

    def submit(self, path: Path) -> str:
        self.polls[str(path)] = 0
        return str(path)

    def status(self, batch: str) -> str:
        self.polls[batch] += 1
        return "completed" if self.polls[batch] > 1 else "in_progress"

    def output(self, batch: str) -> list[str]:
        out = []
        for line in Path(batch).read_text(encoding="utf-8").splitlines():
            request = json.loads(line)
            items = [json.loads(x) for x in request["body"]["input"][1]["content"].split("BEGIN_INPUTS:\n", 1)[1].split("\n")]
            keys = ("comment_id", "submission_id")
            results = [{k: i[k] for k in keys if k in i} | {"is_forward": None, "value_score": 0.0, "tickers": []} for i in items]
            out.append(json.dumps({"custom_id": request["custom_id"], "response": {"body": {"status": "completed", "output": [{"content": [{"text": json.dumps({"results": results})}]}]}}}))
        return out


def outstanding(requests: Iterable[Path], results: Path, retry_failed: bool = True) -> list[Path]:
    """Request files without a result; with an error marker only if failed ones are to be tried again."""
    done = lambda p: (results / p.name).exists() or (not retry_failed and (results / f"{p.stem}.errors.jsonl").exists())
    return [p for p in sorted(requests) if not done(p)]


def collect(client: BatchClient, requests: Iterable[Path], results: Path, in_flight: int = 10, poll_seconds: float = 15, retry_failed: bool = True, sleep: Callable[[float], None] = time.sleep) -> dict[str, str]:
    """Keep up to ``in_flight`` batches running until all have ended; what they have put out goes to files, and an error
    marker where there is nothing."""
    results.mkdir(parents=True, exist_ok=True)
    waiting, running, ended = deque(outstanding(requests, results, retry_failed)), {}, {}
    while waiting or running:
        while waiting and len(running) < in_flight:
            path = waiting.popleft()
            running[client.submit(path)] = path
        for batch, path in list(running.items()):
            state = client.status(batch)
            if state in ENDED:
                del running[batch]
                ended[path.name] = state
                lines = client.output(batch)  # ended batches keep the outputs they have, whatever their state
                if lines:
                    (results / path.name).write_text("\n".join(lines) + "\n", encoding="utf-8")
                else:
                    (results / f"{path.stem}.errors.jsonl").write_text(json.dumps({"file": path.name, "status": state}) + "\n", encoding="utf-8")
        if running:
            sleep(poll_seconds)
    return ended


def with_retries(call: Callable[[], list[dict]], tries: int = 3, first_wait: float = 2.0, growth: float = 1.5, sleep: Callable[[float], None] = time.sleep) -> list[dict]:
    """The first non-empty answer; waits grow between tries, the last error is raised."""
    error: Exception | None = None
    for i in range(tries):
        try:
            if rows := call():
                return rows
            error = None
        except Exception as e:  # noqa: BLE001 - whatever the client raises
            error = e
        if i + 1 < tries:
            sleep(first_wait * growth**i)
    if error:
        raise error
    return []


def fetch_bars(source: PriceSource, symbols: Sequence[str], start: str, end: str, batch: int = 75, pause: float = 3.0, sleep: Callable[[float], None] = time.sleep) -> tuple[list[dict], list[str]]:
    """Bars of all symbols in batches, each missing symbol once more by itself; and the symbols without any. Sources may
    write a symbol in other case or with blanks."""
    found = lambda rows: {r["symbol"].strip().upper() for r in rows}
    rows: list[dict] = []
    wanted = sorted(set(symbols))
    for i in range(0, len(wanted), batch):
        if i:
            sleep(pause)
        part = wanted[i : i + batch]
        got = with_retries(lambda part=part: source.bars(part, start, end), sleep=sleep)
        had = found(got)
        for s in [s for s in part if s.strip().upper() not in had]:
            got = got + with_retries(lambda s=s: source.bars([s], start, end), sleep=sleep)
        rows += got
    had = found(rows)
    return rows, [s for s in wanted if s.strip().upper() not in had]
