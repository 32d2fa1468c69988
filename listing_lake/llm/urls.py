"""URL rules by a sort-merge range join.

A rule covers a host with all its subdomains and the paths under a prefix.  With the labels of a host
in reverse order, "org.example.", a host and its subdomains are one interval of keys.  Urls and rules
are cut into ranges of keys, a rule going to every range its interval touches; each range is sorted and
swept once, keeping a stack of the rules whose intervals are open.  Intervals are nested or apart, so
the stack holds just the rules for the url's host.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: After every key that starts with a given key.
_BEYOND = "\U0010ffff"


@dataclass(frozen=True)
class Rule:
    verdict: str  #: allow or block
    host: str
    path: str

    def name(self) -> str:
        return self.host + self.path


def host_of(url: str = "url") -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: str = "url") -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), "."), F.lit("."))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", samples_per_range: int = 16) -> DataFrame:
    """One row per page: ``page_id``, ``host``, ``path``, ``rule`` (host and path of the rule, or null) and ``verdict``.

    ``rules`` has ``verdict``, ``host``, ``path``, and may be large.  Of the rules that fit, the longest
    wins: host and path together, then the longer host; of two verdicts for one rule, block.  Without a
    rule the verdict is ``default``.  A null url has an empty host and path, which only rules with an
    empty host fit; null ids and repeated rows are kept, an empty table gives an empty result.

    There are as many ranges as shuffle partitions in the session.  Their borders come from a sample of
    about ``samples_per_range`` keys each; they decide where rows are worked on, not the result.  A key that spans several ranges is spread over them.
    """
    keyed = pages.select("page_id", host_of().alias("host"), path_of().alias("path"))
    keyed = keyed.withColumn("key", host_key(F.col("host")))
    rules = rules.select("verdict", "host", "path", host_key(F.col("host")).alias("key"))
    borders = _borders(keyed, samples_per_range)
    of_pages = keyed.mapInArrow(
        _ranges(borders), "page_id long, host string, path string, key string, rule string, verdict string, range int"
    )
    of_rules = rules.withColumn("page_id", F.lit(None).cast("long")).select("page_id", "host", "path", "key", "verdict").mapInArrow(
        _touched(borders), "page_id long, host string, path string, key string, rule string, verdict string, range int"
    )
    dealt = of_pages.unionByName(of_rules).repartition(len(borders) + 1, "range")
    # a rule comes before the urls with its key
    swept = dealt.sortWithinPartitions("range", "key", F.col("rule").isNull(), "rule")
    return swept.mapInArrow(_sweep(default), "page_id long, host string, path string, rule string, verdict string")


def _borders(keyed: DataFrame, samples_per_range: int) -> list[str]:
    ranges, rows = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions")), keyed.count()
    share = min(1.0, ranges * samples_per_range / max(rows, 1))
    sample = sorted(r["key"] for r in keyed.sample(share, 7).select("key").collect())
    return [sample[len(sample) * i // ranges] for i in range(1, ranges)] if sample else []


_DEALT = pa.schema(
    [("page_id", pa.int64()), *((c, pa.string()) for c in ("host", "path", "key", "rule", "verdict")), ("range", pa.int32())]
)


def _ranges(borders: list[str]):
    """Each url to the range of its key, by turns if the key spans several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for batch in batches:
            out = []
            for key in batch.column("key").to_pylist():
                low, high = bisect_left(borders, key), bisect_right(borders, key)
                out.append(low + turn % (high - low + 1))
                turn += 1
            none = pa.nulls(batch.num_rows, pa.string())
            yield pa.record_batch([*(batch.column(c) for c in ("page_id", "host", "path", "key")), none, none, pa.array(out, pa.int32())], schema=_DEALT)

    return run


def _touched(borders: list[str]):
    """Each rule to every range that its interval touches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                spans = range(bisect_left(borders, r["key"]), bisect_right(borders, r["key"] + _BEYOND) + 1)
                n = len(spans)
                row = [None, r["host"], r["path"], r["key"], r["host"] + r["path"], r["verdict"]]
                yield pa.record_batch([*(pa.array([x] * n, f.type) for x, f in zip(row, _DEALT)), pa.array(list(spans), pa.int32())], schema=_DEALT)

    return run


def _sweep(default: str):
    result = pa.schema([("page_id", pa.int64()), *((c, pa.string()) for c in ("host", "path", "rule", "verdict"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        #: Open intervals, outermost first: key, the rules by path, and the lengths of these paths.
        stack: list[tuple[str, dict[str, tuple[str, str]], set[int]]] = []
        at = None
        for batch in batches:
            out: list[tuple] = []
            columns = (batch.column(c).to_pylist() for c in ("page_id", "host", "path", "key", "rule", "verdict", "range"))
            for page, host, path, key, rule, verdict, part in zip(*columns):
                if part != at:
                    stack, at = [], part
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if rule is not None:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, {}, set()))
                    old = stack[-1][1].get(path)
                    stack[-1][2].add(len(path))
                    stack[-1][1][path] = (rule, "block" if old and old[1] == "block" else verdict)
                    continue
                best: tuple | None = None
                for depth, (_, paths, lengths) in enumerate(stack):
                    hits = [h for h in (paths.get(path[:n]) for n in lengths if n <= len(path)) if h]
                    best = max([(len(h[0]), depth, h) for h in hits] + ([best] if best else []), default=None)
                out.append((page, host, path, *(best[2] if best else (None, default))))
            yield pa.record_batch([pa.array(x, f.type) for x, f in zip(zip(*out), result)] if out else [pa.array([], f.type) for f in result], schema=result)

    return run
