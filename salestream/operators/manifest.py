"""Which files make up an emission log and its compacted table, and which stream writes them.

The manifest is a small file beside the log, one for each version. It names the stream (by an id that its checkpoint keeps),
the batches that are live in the log, the last batch that has been folded, and for each day of the compacted table the
generation that holds it. Whoever changes the log or the table writes the next version, whole and only if nobody has
written it yet; the loser reads again and applies its change to the winner's. So log, table and checkpoint
change together, and a reader that has read one version sees one state until those files are deleted.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import SparkSession

from salestream import files

_FOLDER = "_manifest"
#: Older versions are deleted as new ones are written.
KEPT_VERSIONS = 10
_ATTEMPTS = 100


class ForeignLog(ValueError):
    """The log belongs to another stream."""


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    stream: str | None = None
    #: Ranges (first and last, both included) of batches that are read from the log.
    batches: tuple[tuple[int, int], ...] = ()
    #: The last batch that the compacted table holds; it and all before are not read from the log.
    folded: int | None = None
    table: str | None = None
    #: Day to the generation (folder) of the compacted table that holds it.
    days: dict[str, str] = field(default_factory=dict)

    def holds(self, batch_id: int) -> bool:
        return any(first <= batch_id <= last for first, last in self.batches)

    @property
    def last(self) -> int | None:
        return max((last for _, last in self.batches), default=None)

    def with_batch(self, batch_id: int) -> Manifest:
        """A batch that is folded already, or there already, was written again and changes nothing."""
        if self.holds(batch_id) or (self.folded is not None and batch_id <= self.folded):
            return self
        return replace(self, batches=ranges([*self.batches, (batch_id, batch_id)]))

    def without(self, upto: int) -> tuple[tuple[int, int], ...]:
        """The live ranges after batch ``upto``."""
        return tuple((max(first, upto + 1), last) for first, last in self.batches if last > upto)


def ranges(given: Iterable[tuple[int, int]]) -> tuple[tuple[int, int], ...]:
    """Ranges that touch, joined."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(given):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return tuple(out)


def _versions(spark: SparkSession, log_path: str) -> list[int]:
    names = files.children(spark, f"{log_path}/{_FOLDER}")
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def _path(log_path: str, version: int) -> str:
    return f"{log_path}/{_FOLDER}/{version:020}.json"


def read(spark: SparkSession, log_path: str) -> Manifest | None:
    """The newest version; None for a log that no stream or compaction has taken over yet."""
    versions = _versions(spark, log_path)
    if not versions:
        return None
    found = json.loads(files.read_text(spark, _path(log_path, versions[-1])))
    return Manifest(**{**found, "batches": tuple(tuple(r) for r in found["batches"])})


def listed(spark: SparkSession, log_path: str) -> Manifest:
    """What a log without manifest amounts to: all its batches are live."""
    names = [n for n in files.children(spark, log_path) if n.startswith("batch_id=")]
    ids = [int(n.removeprefix("batch_id=")) for n in names]
    return Manifest(version=-1, batches=ranges((i, i) for i in ids))


def change(spark: SparkSession, log_path: str, step: Callable[[Manifest], Manifest], create: bool = True) -> Manifest | None:
    """Apply ``step`` to the newest version and write the result as the next; nothing is written if it is the same.

    ``create=False`` leaves a log without manifest as it is.
    """
    for _ in range(_ATTEMPTS):
        found = read(spark, log_path)
        if found is None and not create:
            return None
        before = found or listed(spark, log_path)
        after = step(before)
        if after == before and found is not None:
            return found
        after = replace(after, version=before.version + 1)
        if files.write_new(spark, _path(log_path, after.version), json.dumps(asdict(after))):
            for old in _versions(spark, log_path)[:-KEPT_VERSIONS]:
                files.delete(spark, _path(log_path, old))
            return after
    raise RuntimeError(f"the manifest of {log_path} could not be written in {_ATTEMPTS} attempts")


def own(spark: SparkSession, log_path: str, stream: str) -> Manifest:
    """Enter ``stream`` as the writer of a log that has none and holds nothing."""
    def step(found: Manifest) -> Manifest:
        if found.stream == stream:
            return found
        if found.stream is not None or found.batches or found.days:
            raise ForeignLog(f"{log_path} holds what another stream wrote")
        return replace(found, stream=stream)

    return change(spark, log_path, step)


def add_batch(spark: SparkSession, log_path: str, batch_id: int, stream: str | None = None) -> None:
    """Make a batch live. With ``stream``, only if the log is still that stream's."""
    def step(found: Manifest) -> Manifest:
        if stream is not None and found.stream != stream:
            raise ForeignLog(f"{log_path} is no longer the log of stream {stream}")
        return found.with_batch(batch_id)

    change(spark, log_path, step, create=stream is not None)
