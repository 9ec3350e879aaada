"""Secrets in texts, judged by who else has them.

Candidates are found by pattern. The digest of each candidate's value is counted over the
corpus by distinct repositories and owners: a value that many owners have is a copied
example, one that a single owner or two have may be live. The counts decide whether a long
mixed token with no telling name beside it is reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quadrat.session import cut_lineage

# Patterns of the base kinds (fixed values), in their order: name, what stands before the
# value, the value, its least length.
KINDS = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)""", r"([A-Za-z0-9+/_.=-]+)", 6),
    ("access", r"()", r"(AKIA[A-Z0-9]+)", 20),
    ("hex", r"()", r"([0-9a-f]{24,})", 24),
]
# A run with digits, capitals and small letters; reported where its value is not widely copied.
TOKEN = ("token", r"()", r"([A-Za-z0-9+/_-]{20,})", 20)
COPIED = 3  # owners that make a value a copied example
_OPEN, _MID, _SHUT, _OTHER = "\x01", "\x02", "\x03", "\x04"


def _pieces(text: Column, before: str, value: str) -> Column:
    """The text cut around its matches: outside, before the value, value, outside, and so on."""
    return F.split(F.regexp_replace(text, before + value, f"{_OPEN}$1{_MID}$2{_SHUT}"), f"[{_OPEN}{_MID}{_SHUT}]")


def _matches(kind: int) -> Column:
    """Per match of a kind: lengths of what stands before it and of its parts, and the value's digest."""
    name, _, _, least = [*KINDS, TOKEN][kind]
    count = F.floor(F.size(name) / 3).cast("int")

    def one(k: Column) -> Column:
        value = F.get(name, 3 * k + 2)
        valid = F.length(value) >= least
        if kind == len(KINDS):
            valid = valid & value.rlike("^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])")
        return F.struct(F.lit(kind).alias("kind"), k.alias("place"), F.length(F.get(name, 3 * k)).alias("gap"), F.length(F.get(name, 3 * k + 1)).alias("head"),
                        F.length(value).alias("size"), F.sha2(value, 256).alias("value"), valid.alias("valid"))

    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), one)).otherwise(F.array().cast(_MATCH))


def candidates(df: DataFrame, owner: Column, repository: Column, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(rows, found)``: every row with a number ``row``, and every candidate with its place in the row."""
    clean = F.translate(F.coalesce(F.col(text), F.lit("")), _OPEN + _MID + _SHUT, _OTHER * 3)
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), owner.alias("owner"), repository.alias("repository"), clean.alias("text"))
    for name, before, value, _ in [*KINDS, TOKEN]:
        rows = rows.withColumn(name, _pieces(F.col("text"), before, value))
    rows = cut_lineage(rows.select("row", "key", "owner", "repository", F.concat(*[_matches(k) for k in range(len(KINDS) + 1)]).alias("found")))
    ahead = W.partitionBy("row", "kind").orderBy("place")
    found = rows.filter(F.size("found") > 0).select("row", "owner", "repository", F.inline("found"))
    end = F.sum(F.col("gap") + F.col("head") + F.col("size")).over(ahead)
    found = found.withColumn("end", end).withColumn("start", F.col("end") - F.col("head") - F.col("size")).filter("valid")
    return rows.select("row", "key"), found.select("row", "owner", "repository", "kind", "start", "end", "value")


_MATCH = "array<struct<kind:int,place:int,gap:int,head:int,size:int,value:string,valid:boolean>>"


def ownership(found: DataFrame) -> DataFrame:
    """Per value digest: distinct owners and distinct repositories; null owners count as one."""
    repositories = found.groupBy("value", "owner", "repository").agg(F.lit(1).alias("one"))
    owners = repositories.groupBy("value", "owner").agg(F.count("one").alias("n"))
    return owners.groupBy("value").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_repositories"))


def find_secrets(df: DataFrame, owner: Column, repository: Column, key: str = "doc_id", text: str = "text", copied: int = COPIED) -> DataFrame:
    """Per row: key, ``base`` and ``spans``, arrays of (start, kind, end, n_owners, n_repositories) in order.

    ``base`` holds the matches of the base kinds. ``spans`` adds tokens that fewer than
    ``copied`` owners have and that touch no base match. A null text is empty; repeated rows are
    searched each for itself but count once for an owner and repository.
    """
    rows, found = candidates(df, owner, repository, key, text)
    found = cut_lineage(found)
    known = found.join(ownership(found), "value")
    base = F.col("kind") < len(KINDS)
    order = W.partitionBy("row").orderBy("start", "kind")
    behind = F.max(F.when(base, F.col("end"))).over(order.rowsBetween(W.unboundedPreceding, -1))
    ahead = F.min(F.when(base, F.col("start"))).over(order.rowsBetween(1, W.unboundedFollowing))
    # of several rows at one place the base kinds come first, so a token there sees them behind it
    known = known.withColumn("free", (F.coalesce(behind, F.lit(0)) <= F.col("start")) & (F.coalesce(ahead, F.col("end")) >= F.col("end")))
    known = known.filter(base | (F.col("free") & (F.col("n_owners") < copied)))
    span = F.struct("start", "kind", "end", "n_owners", "n_repositories")
    spans = known.groupBy("row").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    out = rows.join(spans, "row", "left").withColumn("spans", F.coalesce("spans", F.array().cast(_SPANS)))
    return out.select(F.col("key").alias(key), F.filter("spans", lambda s: s["kind"] < len(KINDS)).alias("base"), "spans")


_SPANS = "array<struct<start:bigint,kind:int,end:bigint,n_owners:bigint,n_repositories:bigint>>"
_NAMES = [name for name, *_ in [*KINDS, TOKEN]]


def joined(spans: str) -> Column:
    name = lambda s: F.get(F.array(*map(F.lit, _NAMES)), s["kind"])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(found: DataFrame, key: str = "doc_id", copied: int = COPIED) -> DataFrame:
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        key, *[count(k).alias(f"n_{name}") for k, name in enumerate(_NAMES)], F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"),
        F.size(F.filter("spans", lambda s: s["n_owners"] >= copied)).cast("long").alias("n_copied"))
