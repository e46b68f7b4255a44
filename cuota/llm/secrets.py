"""Secrets in texts, judged by who else has them, in DataFrame operations only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuota.llm.common import stored, text_or_empty, without


@dataclass(frozen=True)
class Kind:
    """A pattern, how many characters of `group` a match needs, and (of an added kind) what else the match must hold."""

    name: str
    pattern: str
    least: int
    group: int = 0
    holds: tuple[str, ...] = ()


# Fixed patterns of the base kinds, in listing order. A match that is too short is dropped after it has been consumed.
# Runs of `hex` and `access` are maximal, so asking for the length inside the pattern finds the same matches.
ASSIGN = Kind("assign", r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
              r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
              r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, 1)
ACCESS = Kind("access", r"AKIA[A-Z0-9]{16,}", 20)
HEX = Kind("hex", r"[0-9a-f]{24,}", 24)
BASE = (ASSIGN, ACCESS, HEX)
# The kind that ownership adds: long mixed strings that no base match covers and that one owner alone has.
OWNED = Kind("owned", r"[A-Za-z0-9+/_-]{20,}", 20, holds=("[0-9]", "[a-z]", "[A-Z]"))

# A value found with this many owners, or with several and in this many repositories, is a copied example. What one owner
# alone has is live, however many of its repositories hold it.
EXAMPLE_OWNERS = 3
EXAMPLE_REPOS = 20

_ADDED = ("n_assign", "n_access", "n_hex", "n_owned", "n_live", "n_example", "base_sha256", "spans")


def found_in(text: str, kind: Kind) -> Column:
    """Array of (gap, width, value hash, good) per match, left to right; gap counts the characters since the last match.

    The pieces between matches and the matches come from two passes of the same pattern, so their lengths give the
    positions in code points. Texts without a match are only searched once.
    """
    pattern = F.lit(kind.pattern)
    matches = F.regexp_extract_all(F.col(text), pattern, F.lit(0))
    values = F.regexp_extract_all(F.col(text), pattern, F.lit(kind.group))
    gaps = F.slice(F.split(F.col(text), kind.pattern, -1), 1, F.size(matches))
    rows = F.arrays_zip(gaps.alias("gap"), matches.alias("match"), values.alias("value"))

    def describe(x: Column) -> Column:
        good = F.length(x["value"]) >= kind.least
        for part in kind.holds:
            good = good & x["value"].rlike(part)
        return F.struct(F.length(x["gap"]).cast("long").alias("gap"), F.length(x["match"]).cast("long").alias("width"),
                        F.sha2(x["value"], 256).alias("hash"), good.alias("good"))

    return F.when(F.col(text).rlike(kind.pattern), F.transform(rows, describe))


def candidates(df: DataFrame, kinds: tuple[Kind, ...], text: str, keep: list[Column]) -> DataFrame:
    """One row per good match: the kept columns, `_kind` (number in `kinds`), `_start`, `_end` and `_hash`.

    `df` has a column `_found<i>` per kind, as `found_in` gives it.
    """
    parts = [df.where(F.size(f"_found{i}") > 0).select(*keep, F.lit(i).alias("_kind"),
                                                     F.posexplode(f"_found{i}").alias("_n", "_m"))
             for i in range(len(kinds))]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionAll(part)
    so_far = Window.partitionBy("_row", "_kind").orderBy("_n").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("_m.gap") + F.col("_m.width")).over(so_far)
    return (rows.withColumn("_end", end).where("_m.good").withColumn("_start", F.col("_end") - F.col("_m.width"))
            .withColumn("_hash", F.col("_m.hash")).drop("_n", "_m"))


def ownership(found: DataFrame, owner: str, repo: str, example_owners: int, example_repos: int) -> DataFrame:
    """Per value hash: `live` (one owner's own), `example` (copied by many) or `shared`; nulls are an owner of their own.

    Repeats within an owner and repository are folded before the counts, so a widely copied value is a row per task.
    """
    named = found.select("_hash", F.struct(owner).alias("_owner"), F.struct(repo).alias("_repo")).distinct()
    counts = named.groupBy("_hash").agg(F.countDistinct("_owner").alias("_owners"),
                                        F.countDistinct("_repo").alias("_repos"))
    many = (F.col("_owners") >= example_owners) | (F.col("_repos") >= example_repos)
    return counts.select(F.col("_hash").alias("_judged"), F.when(F.col("_owners") == 1, "live")
                         .when(many, "example").otherwise("shared").alias("_class"))


def _listing(spans: Column, names: tuple[str, ...]) -> Column:
    """kind:start:end of an array of (start, kind number, end), by start and then kind, joined by commas."""
    labels = F.array(*[F.lit(n) for n in names])
    return F.concat_ws(",", F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(labels, s["_kind"] + 1), s["_start"].cast("string"), s["_end"].cast("string"))))


def scan_secrets(df: DataFrame, *, text: str = "text", owner: str = "source", repo: str = "doc_id",
                 example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS) -> DataFrame:
    """The columns of `df` but `text`, with the secrets of each text.

    Adds `n_assign`, `n_access`, `n_hex` (base matches), `n_owned` (added ones), `n_live` and `n_example` (of all spans,
    by the ownership of their value over the whole input: one owner's own in however many repositories, or copied by
    several owners into many),
    `base_sha256` and `spans`. Base matches are always listed; ownership decides which long mixed strings are added:
    those that overlap no base match and that one owner alone has.

    Null text is the empty text: no spans, hash of the empty listing. Every input row gives one row, repeated rows too;
    null owners and repositories count as one. An empty table gives an empty result. Columns of `df` named like the
    added ones are replaced. Texts are read once and go nowhere: what is stored and joined holds positions and hashes.
    """
    kinds = (*BASE, OWNED)
    carried = [c for c in without(df, text, *_ADDED).columns]
    named = [F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carried)]
    texts = df.select(*named, F.monotonically_increasing_id().alias("_row"), text_or_empty(text).alias("_text"),
                      F.struct(F.col(owner)).alias("_owner_of"), F.struct(F.col(repo)).alias("_repo_of"))
    scanned = stored(texts.select(*[c for c in texts.columns if c != "_text"],
                                  *[found_in("_text", k).alias(f"_found{i}") for i, k in enumerate(kinds)]),
                     "secrets-found")
    keep = [F.col(c) for c in ("_row", "_owner_of", "_repo_of")]
    found = stored(candidates(scanned, kinds, "_text", keep), "secrets-candidates")
    judged = ownership(found, "_owner_of", "_repo_of", example_owners, example_repos)
    spans = found.join(judged, F.col("_hash") == F.col("_judged")).drop("_hash", "_judged", "_owner_of", "_repo_of")

    in_order = Window.partitionBy("_row").orderBy("_start", "_kind")
    base = F.col("_kind") < len(BASE)
    left = F.max(F.when(base, F.col("_end"))).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    right = F.min(F.when(base, F.col("_start"))).over(in_order.rowsBetween(1, Window.unboundedFollowing))
    free = (F.coalesce(left, F.lit(0)) <= F.col("_start")) & (F.coalesce(right, F.col("_end")) >= F.col("_end"))
    listed = (spans.withColumn("_free", free).where(base | F.col("_free") & (F.col("_class") == "live"))
              .select("_row", "_class", F.struct("_start", "_kind", "_end").alias("_span")))
    one = lambda condition: F.count(F.when(condition, 1))
    per_row = listed.groupBy("_row").agg(
        *[one(F.col("_span._kind") == i).alias(f"n_{k.name}") for i, k in enumerate(kinds)],
        one(F.col("_class") == "live").alias("n_live"), one(F.col("_class") == "example").alias("n_example"),
        F.collect_list("_span").alias("_spans"))
    joined = scanned.select("_row", *[f"_c{i}" for i in range(len(carried))]).join(per_row, "_row", "left")
    spans_of = F.coalesce("_spans", F.array().cast("array<struct<_start:bigint,_kind:int,_end:bigint>>"))
    names = tuple(k.name for k in kinds)
    counts = [F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in _ADDED[:6]]
    return joined.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(carried)], *counts, F.sha2(
        _listing(F.filter(spans_of, lambda s: s["_kind"] < len(BASE)), names), 256).alias("base_sha256"),
        _listing(spans_of, names).alias("spans"))
