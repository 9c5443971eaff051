"""URL rules looked up in sorted digest arrays that every task maps into memory.

Rules are cut into segments by the digest of their host. A segment is one file in the shared folder: the sorted
64-bit digests of its hosts with the path lengths that occur under each, the sorted digests of its whole rules, and
the rules themselves. Spark hands the files to every executor, where tasks map them and read only the pages that a
search touches. A url's host suffixes are looked up by one vectorised binary search a batch; those that are found
are looked up again together with as much of the path as rules of that host have; a found digest counts only
where the stored rule is equal to the whole string.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import arrow_udf

from vigil.session import shared_folder

VERDICTS = ("allow", "block")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ALL_BITS = (1 << 64) - 1


def url_host(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; empty without `://`."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty without `://`."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def digests(strings: Iterable[bytes], mask: int = _ALL_BITS) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(s) & mask for s in strings), np.uint64)


# The file: six counts, then these arrays one after the other, longest numbers first.

_ARRAYS = (("host_keys", "<u8"), ("host_first", "<i8"), ("rule_keys", "<u8"), ("rule_first", "<i8"),
           ("lengths", "<i4"), ("host_bytes", "<i4"), ("chars", "<i4"), ("verdicts", "u1"), ("strings", "u1"))


def segment_bytes(rules: list[tuple[str, str, str]], mask: int = _ALL_BITS) -> bytes:
    """The file of the distinct rules (host, path, verdict)."""
    hosts = [h.encode() for h, _, _ in rules]
    paths = [p.encode() for _, p, _ in rules]
    lengths: dict[int, set[int]] = {}
    for key, path in zip(digests(hosts, mask).tolist(), paths):
        lengths.setdefault(key, set()).add(len(path))
    found = sorted(lengths)
    whole = [h + p for h, p in zip(hosts, paths)]
    keys = digests(whole, mask)
    order = np.argsort(keys, kind="stable")
    arrays = {
        "host_keys": found,
        "host_first": np.cumsum([0, *(len(lengths[k]) for k in found)]),
        "lengths": [n for k in found for n in sorted(lengths[k])],
        "rule_keys": keys[order],
        "rule_first": np.cumsum([0, *(len(whole[i]) for i in order)]),
        "host_bytes": [len(hosts[i]) for i in order],
        "chars": [len(rules[i][0]) + len(rules[i][1]) for i in order],
        "verdicts": [VERDICTS.index(rules[i][2]) for i in order],
        "strings": np.frombuffer(b"".join(whole[i] for i in order), "u1"),
    }
    parts = [np.asarray(arrays[name], kind) for name, kind in _ARRAYS]
    return np.array([len(p) for p in parts], "<i8").tobytes() + b"".join(p.tobytes() for p in parts)


class DigestArray:
    """A segment, mapped into memory."""

    def __init__(self, file: str, mask: int = _ALL_BITS):
        sizes = np.fromfile(file, "<i8", len(_ARRAYS))
        at = sizes.nbytes
        for (name, kind), size in zip(_ARRAYS, sizes.tolist()):
            setattr(self, name, np.memmap(file, kind, "r", at, (size,)) if size else np.empty(0, kind))
            at += size * np.dtype(kind).itemsize
        self.mask = mask

    def path_lengths(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in `keys`, path length) for every path length under a host of that digest."""
        at = np.searchsorted(self.host_keys, keys)
        hit = np.flatnonzero(at < len(self.host_keys))
        hit = hit[self.host_keys[at[hit]] == keys[hit]]
        first, end = self.host_first[at[hit]], self.host_first[at[hit] + 1]
        return np.repeat(hit, end - first), self.lengths[_ranges(first, end)].astype(np.int64)

    def rules(self, strings: list[bytes], host_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in `strings`, number of the rule) where a stored rule is that string, cut after that host."""
        keys = digests(strings, self.mask)
        first, end = np.searchsorted(self.rule_keys, keys), np.searchsorted(self.rule_keys, keys, "right")
        place, rule = np.repeat(np.arange(len(keys)), end - first), _ranges(first, end)
        equal = self.host_bytes[rule] == host_bytes[place]
        place, rule = place[equal], rule[equal]
        same = np.fromiter((self.text(r) == strings[p] for p, r in zip(place.tolist(), rule.tolist())), bool, len(place))
        return place[same], rule[same]

    def text(self, rule: int) -> bytes:
        return self.strings[self.rule_first[rule] : self.rule_first[rule + 1]].tobytes()


def _ranges(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers from each `first` up to its `end`, one range after the other."""
    sizes = (end - first).astype(np.int64)
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(first, sizes).astype(np.int64)


@functools.lru_cache(maxsize=256)
def _mapped(name: str, mask: int) -> DigestArray:
    return DigestArray(SparkFiles.get(name), mask)


def longest_rules(segments: list[DigestArray], hosts: list[bytes], paths: list[bytes], most_labels: int):
    """For each url (rule text, verdict) of the longest rule that fits, or None."""
    rows, suffixes = [], []
    for row, host in enumerate(hosts):
        cut = len(host)
        for _ in range(most_labels):
            dot = host.rfind(b".", 0, cut)
            rows.append(row)
            suffixes.append(host[dot + 1 :])
            if dot < 0:
                break
            cut = dot
    mask = segments[0].mask
    keys, rows = digests(suffixes, mask), np.array(rows, np.int64)
    owner = keys % np.uint64(len(segments))
    best: list[tuple | None] = [None] * len(hosts)
    for n, segment in enumerate(segments):
        own = np.flatnonzero(owner == n)
        place, lengths = segment.path_lengths(keys[own])
        place = own[place]
        fits = lengths <= np.fromiter((len(paths[r]) for r in rows[place].tolist()), np.int64, len(place))
        place, lengths = place[fits], lengths[fits]
        wanted = [suffixes[p] + paths[rows[p]][:size] for p, size in zip(place.tolist(), lengths.tolist())]
        sizes = np.fromiter((len(suffixes[p]) for p in place.tolist()), np.int64, len(place))
        found, rule = segment.rules(wanted, sizes)
        for p, r in zip(found.tolist(), rule.tolist()):
            row = rows[place[p]]
            rank = (int(segment.chars[r]), int(segment.host_bytes[r]))
            if best[row] is None or rank > best[row][0]:
                best[row] = (rank, wanted[p].decode(), VERDICTS[segment.verdicts[r]])
    return [b and b[1:] for b in best]


class UrlFilter:
    """Rules as segments in the shared folder, ready for every executor."""

    def __init__(self, spark: SparkSession, rules: DataFrame, rules_a_segment: int = 1_000_000, mask: int = _ALL_BITS):
        """`rules`: rule (host and path, the path from the first `/` on) and verdict (allow or block).

        A rule given with both verdicts blocks. Null rules, and rules without a host, are left out. The driver
        holds one segment at a time; there are as many as the rules need.
        """
        host = F.translate(F.substring_index("rule", "/", 1), _UPPER, _LOWER)
        parsed = rules.where("rule is not null").select(
            host.alias("host"), F.substring(F.col("rule"), F.length(host) + 1, F.length("rule")).alias("path"), "verdict")
        known = parsed.where("host <> ''").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
        size, self.most_labels, self.most_path, odd = known.agg(
            F.count("*"), F.max(F.size(F.split("host", r"\."))), F.max(F.length("path")),
            F.count_if(F.coalesce(~F.col("verdict").isin(*VERDICTS), F.lit(True)))).first()
        if odd:
            raise ValueError(f"a verdict is one of {VERDICTS}")
        self.mask = mask
        self.names = []
        folder, tag, count = shared_folder(spark).rstrip("/"), uuid.uuid4().hex, max(1, -(-size // rules_a_segment))
        numbered = known.withColumn("segment", _segment("host", count, mask))
        for n in range(count):
            rows = [tuple(r) for r in numbered.where(F.col("segment") == n).select("host", "path", "verdict").toLocalIterator()]
            path = f"{folder}/url-rules-{tag}-{n}"
            _put(spark, path, segment_bytes(rows, mask))
            spark.sparkContext.addFile(path)
            self.names.append(path.rsplit("/", 1)[1])

    def __call__(self, host: Column, path: Column) -> Column:
        """struct of rule and verdict of the longest rule that fits, both null where none does."""
        names, mask, most_labels = self.names, self.mask, self.most_labels or 1

        @arrow_udf("rule string, verdict string")
        def judge(hosts: pa.Array, paths: pa.Array) -> pa.Array:
            segments = [_mapped(name, mask) for name in names]
            found = longest_rules(segments, hosts.to_pylist(), paths.to_pylist(), most_labels)
            return pa.array([{"rule": f and f[0], "verdict": f and f[1]} for f in found],
                            pa.struct([("rule", pa.string()), ("verdict", pa.string())]))

        # No rule has more labels or a longer path, so that long urls stay where they are.
        return judge(F.substring_index(host, ".", -most_labels).cast("binary"),
                     F.substring(path, 1, self.most_path or 0).cast("binary"))


def _segment(host: str, count: int, mask: int) -> Column:
    @arrow_udf("int")
    def segment(hosts: pa.Array) -> pa.Array:
        return pa.array((digests(hosts.to_pylist(), mask) % np.uint64(count)).astype(np.int32))

    return segment(F.col(host).cast("binary"))


def _put(spark: SparkSession, path: str, data: bytes) -> None:
    """Write a file of the shared folder, whatever file system that is on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def judge_urls(pages: DataFrame, rules: DataFrame, otherwise: str = "allow", **options) -> DataFrame:
    """One row per row of `pages` (page_id, url): page_id, host, path, rule and verdict.

    A rule fits its host and all subdomains where the url's path starts with the rule's; the longest rule in code
    points wins, and of equally long ones that with the longer host. Where none fits, rule is null and the verdict
    is `otherwise`. A null url, or one without `://`, has an empty host and path. Repeated rows, null page_ids and
    long urls are rows like others, other columns are not read, and an empty table or no rules are allowed.
    """
    known = UrlFilter(pages.sparkSession, rules, **options)
    parts = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    judged = parts.withColumn("found", known(F.col("host"), F.col("path")))
    return judged.select(
        "page_id", "host", "path", "found.rule", F.coalesce("found.verdict", F.lit(otherwise)).alias("verdict"))
