"""A Merkle manifest of a dataset as labelled intervals.

Every node carries the interval of leaf ranks that it covers. Ranks come from a range-partitioned sort, so that no
group is ever numbered in one task; the nodes of a level are made from those of the level below by one grouping into
runs of `FAN` neighbours. Ancestors are attached from the root down: nodes of a level join the level above by
containment of their intervals within buckets of that level's width, and the siblings of a node are its parent's
children on either side of its own interval. Texts are read once and never moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigil.session import materialize

#: Fixed value: how many consecutive nodes become one.
FAN = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _field(value: Column) -> Column:
    """`-` for null, else the length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _leaf(text: Column) -> Column:
    return digest(_field(F.col("doc_id").cast("bigint")), _field(F.col("source")), _field(F.col("lang")),
                  _field(F.col("n_chars").cast("bigint")), _field(text))


def tampered(doc_id: Column) -> Column:
    """Whether 3 divides the crc32 of the decimal doc_id; never of a null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))


# Ranks


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """`rows` with their place `lo` within the group, from 0, the end `hi` of that place, and the group's size `n`.

    Sorted by range, so that a group is spread over tasks as its size asks; only the sizes of a group's parts are
    added up across tasks. Rows that are equal in `order` are numbered in the order in which they are read."""
    rows = materialize(rows.withColumn("tie", F.monotonically_increasing_id()), "unranked")
    keys = [F.col(c).asc_nulls_first() for c in (group, *order, "tie")]
    spread = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie")
    stored = materialize(
        spread.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "sorted")
    parts = stored.groupBy("part", group).agg(F.count("*").alias("size"), F.min("at").alias("first"))
    own = Window.partitionBy(group)
    before = F.sum("size").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = materialize(parts.select(
        F.col("part").alias("of_part"), F.col(group).alias("of_group"),
        (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("size").over(own).alias("n")), "starts")
    placed = stored.join(starts, (F.col("part") == F.col("of_part")) & F.col(group).eqNullSafe(F.col("of_group")))
    lo = F.col("at") + F.col("shift")
    return placed.withColumns({"lo": lo, "hi": lo + 1}).drop("part", "at", "of_part", "of_group", "shift")


# Levels


def _width(level: int) -> int:
    return FAN**level


def _bucket(level: int) -> Column:
    return F.floor(F.col("lo") / F.lit(_width(level))).cast("bigint")


def _parents(nodes: DataFrame, group: str, level: int) -> DataFrame:
    """The nodes of `level` over those of the level below, for groups that have several there."""
    children = F.sort_array(F.collect_list(F.struct("lo", "hi", "digest")))
    return nodes.where(F.col("n") > _width(level - 1)).groupBy(group, _bucket(level).alias("bucket")).agg(
        children.alias("children"), F.first("n").alias("n")).select(
        group, "n", "children", F.col("children")[0]["lo"].alias("lo"),
        F.element_at("children", -1)["hi"].alias("hi"),
        digest(F.array_join(F.transform("children", lambda c: c["digest"]), "")).alias("digest"))


def levels(leaves: DataFrame, group: str) -> list[DataFrame]:
    """The nodes of every level as written tables, from the leaves (digest, lo, hi, n) up to the last lone ones."""
    out = [leaves]
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > _width(len(out) - 1):
        out.append(materialize(_parents(out[-1], group, len(out)), f"level-{len(out)}"))
    return out


def tops(nodes: list[DataFrame], group: str) -> DataFrame:
    """The lone node of each group: its group and digest."""
    alone = [level.where(F.col("n") <= _width(i)).where("n > 0") for i, level in enumerate(nodes)]
    # A group ends at the first level where it is alone, and has no nodes above.
    found = alone[0].select(group, "digest")
    for level in alone[1:]:
        found = found.unionByName(level.select(group, "digest"))
    return found


def _attached(nodes: DataFrame, above: DataFrame | None, ends: DataFrame | None, group: str, level: int) -> DataFrame:
    """The nodes of a level with their `path` to the root (the siblings' digests left and right of each step) and
    their group's `subroot`: lone nodes take both from `ends`, others from the node `above` that contains them.
    Without `ends` a lone node is the root of all."""
    alone = nodes.where(F.col("n") <= _width(level))
    if ends is None:
        joined = alone.withColumns({"path": F.array().cast(_PATH), "subroot": F.lit(None).cast("string")})
    else:
        joined = alone.join(ends, F.col(group).eqNullSafe(F.col("end_group"))).drop("end_group")
    if above is None:
        return joined
    parent = above.select(
        F.col(group).alias("p_group"), _bucket(level + 1).alias("p_bucket"), F.col("lo").alias("p_lo"),
        F.col("hi").alias("p_hi"), F.col("children").alias("run"), F.col("path").alias("rest"), "subroot")
    inside = nodes.where(F.col("n") > _width(level)).withColumn("bucket", _bucket(level + 1)).join(
        parent, F.col(group).eqNullSafe(F.col("p_group")) & (F.col("bucket") == F.col("p_bucket"))
        & (F.col("p_lo") <= F.col("lo")) & (F.col("hi") <= F.col("p_hi")))

    def beside(holds) -> Column:
        return F.array_join(F.transform(F.filter("run", holds), lambda c: c["digest"]), "")

    step = F.struct(beside(lambda c: c["hi"] <= F.col("lo")).alias("left"),
                    beside(lambda c: c["lo"] >= F.col("hi")).alias("right"))
    found = inside.withColumn("path", F.concat(F.array(step), F.col("rest"))).drop(
        "bucket", "p_group", "p_bucket", "p_lo", "p_hi", "run", "rest")
    return joined.unionByName(found)


def with_paths(nodes: list[DataFrame], ends: DataFrame | None, group: str) -> DataFrame:
    """The leaves of `levels` with `path` and `subroot`. `ends`: end_group, path and subroot of each group's top,
    or None where there is one group."""
    above = None
    for level in range(len(nodes) - 1, 0, -1):
        above = materialize(_attached(nodes[level], above, ends, group, level), f"attached-{level}")
    return _attached(nodes[0], above, ends, group, 0)


# The manifest


def proof(path: Column) -> Column:
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to along its path."""
    return F.aggregate(path, leaf, lambda node, s: digest(s["left"], node, s["right"]))


def manifest(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, source, lang, n_chars, text): doc_id, leaf, subroot, root, proof_sha256,
    folded_root and verified.

    A leaf is the SHA-256 in hex of the five values, each `-` if null, else its length in UTF-8 bytes, `:` and the
    value. Leaves of a lang, null being one, are in the order of doc_id, nulls first, then of the leaf; every `FAN`
    consecutive nodes become the hash of their digests until one is left, the subroot; the subroots in the order of
    lang, null first, in the same way become the root. `proof_sha256` is the hash of all siblings from the leaf to
    the root; `folded_root` is made from the leaf, its text in lower case where `tampered` holds, along the same
    siblings, and `verified` says whether it is the root. Rows that repeat are leaves of their own. Other columns
    are not read; an empty table has no rows.
    """
    lower = F.translate("text", _UPPER, _LOWER)
    hashed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        _leaf(F.col("text")).alias("digest"),
        F.when(tampered(F.col("doc_id").cast("bigint")), _leaf(lower)).alias("changed"))
    by_lang = levels(ranked(hashed, "lang", ["doc_id", "digest"]), "lang")

    roots = ranked(tops(by_lang, "lang").withColumn("all", F.lit(0)), "all", ["lang"])
    above = levels(roots, "all")
    last = tops(above, "all").first()  # one row
    root = F.lit(last and last["digest"]).cast("string")
    subroots = materialize(with_paths(above, None, "all").select(
        F.col("lang").alias("end_group"), "path", F.col("digest").alias("subroot")), "subroots")

    leaves = with_paths(by_lang, subroots, "lang")
    return leaves.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", root.alias("root"), proof(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("changed", "digest"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def manifest_sql(depth: int = 9) -> str:
    """`manifest` as SQL over documents, for langs of up to FAN^depth rows."""
    def field(value: str) -> str:
        return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(map(field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"

    def tree(name: str, group: str) -> list[str]:
        """Tables of each level: place k, digest, whether it is alone, and the digests beside it."""
        made = []
        for i in range(depth + 1):
            below = f"{name}{i - 1}"
            source = name if i == 0 else (
                f"(SELECT {group}, CASE WHEN alone THEN k ELSE k // {FAN} END AS k, CASE WHEN any_value(alone) THEN any_value(digest) "
                f"ELSE sha256(string_agg(digest, '' ORDER BY k)) END AS digest FROM {below} GROUP BY {group}, CASE WHEN alone THEN k ELSE k // {FAN} END)")
            run = f"OVER (PARTITION BY {group}, k // {FAN} ORDER BY k ROWS BETWEEN"
            made.append(f"""{name}{i} AS (
  SELECT {group}, k, digest, count(*) OVER (PARTITION BY {group}) = 1 AS alone,
         coalesce(string_agg(digest, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(digest, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {source})""")
        return made

    def climb(name: str, start: str, group: str, out: str) -> list[str]:
        """Tables that take each row of `start` (place k, node, beside) a level up."""
        made = []
        for i in range(depth):
            below = start if i == 0 else f"{out}{i - 1}"
            made.append(f"""{out}{i} AS (
  SELECT a.* REPLACE (CASE WHEN b.alone THEN a.k ELSE a.k // {FAN} END AS k,
                      CASE WHEN b.alone THEN node ELSE sha256(b.l || node || b.r) END AS node, beside || b.l || b.r AS beside)
  FROM {below} a JOIN {name}{i} b ON a.{group} IS NOT DISTINCT FROM b.{group} AND a.k = b.k)""")
        return made

    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    ctes = [
        f"""steps AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda c, z: {step})) AS tab)""",
        """crcs AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1),
      lambda j: ascii(substr(doc_id::VARCHAR, j, 1))::BIGINT)), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS crc
  FROM documents, steps)""",
        f"""hashed AS (
  SELECT doc_id, lang, {leaf('text')} AS digest, CASE WHEN crc % 3 = 0 THEN {leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS changed
  FROM crcs)""",
        """leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, digest) - 1 AS k FROM hashed)""",
        "n AS (SELECT lang, k, digest FROM leaves)", *tree("n", "lang"),
        f"""t AS (SELECT 0 AS g, lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS k, digest FROM n{depth})""",
        *tree("t", "g"),
        "own AS (SELECT *, coalesce(changed, digest) AS node, '' AS beside FROM leaves)", *climb("n", "own", "lang", "up"),
        f"""turned AS (SELECT u.* EXCLUDE (k), t.k, t.g, t.digest AS subroot FROM up{depth - 1} u JOIN t ON u.lang IS NOT DISTINCT FROM t.lang)""",
        *climb("t", "turned", "g", "top"),
    ]
    return f"""WITH {", ".join(ctes)}
SELECT doc_id, a.digest AS leaf, subroot, b.digest AS root, sha256(beside) AS proof_sha256, node AS folded_root,
       node = b.digest AS verified
FROM top{depth - 1} a JOIN t{depth} b ON true"""
