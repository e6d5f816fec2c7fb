"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Patterns find candidates in every whole text. The hash of each candidate is
counted over the corpus by distinct repositories and owners. A candidate of many
owners is a copied example; one of few owners looks like a live credential. The
rigid kinds are reported either way, with that verdict. Loose candidates
(``opaque``: long runs with letters and digits) would be mostly noise on their
own and are reported only where their owners are few.

Spark's regex functions give matches but not their places. The places follow
from the text split at the matches: the lengths of gaps and matches, added up.

Results are defined as follows. A null text is an empty one. Spans are in code
points, end exclusive. Matches of a kind don't overlap; kinds may. A null
repository or owner counts as one value. Equal rows give equal rows. An empty
table gives an empty result. Further columns are ignored by ``scan_secrets`` and
kept by ``redact_secrets``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.common import pick
from orderflow.session import staged


@dataclass(frozen=True)
class Kind:
    """A pattern, the group that is the secret, and how long that must be."""

    name: str
    pattern: str
    group: int
    least: int
    base: bool = True


# Runs are maximal, so asking for the least length in the pattern drops the same
# runs that a later check would; the first pattern's matches depend on the short
# ones before them and are checked afterwards.
KINDS = (
    Kind(
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        1,
        8,
    ),
    Kind("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    Kind("hex", r"[0-9a-f]{32,}", 0, 32),
    Kind("opaque", r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{20,}", 0, 20, False),
)

#: A candidate of more distinct owners, or of more repositories, is a copied example.
MAX_OWNERS = 2
MAX_REPOSITORIES = 20
#: Distinct characters an opaque candidate must have, so that rulers and fillers don't count.
OPAQUE_LETTERS = 10


def _pieces(kind: Kind):
    """Gap before, length and secret of each match, and a last gap without a match."""
    pattern = F.lit(kind.pattern)
    gaps = F.transform(F.split("text", kind.pattern, -1), F.length)
    hits = F.transform(F.regexp_extract_all("text", pattern, F.lit(0)), F.length)
    values = F.regexp_extract_all("text", pattern, F.lit(kind.group))
    return F.arrays_zip(gaps.alias("gap"), hits.alias("size"), values.alias("value"))


def _candidates(found: DataFrame) -> DataFrame:
    """One row per candidate: its row, kind, place and secret."""
    rows = reduce(
        DataFrame.unionByName,
        [
            found.where(F.size(kind.name) > 1).select(
                "row", "repo", "owner", F.lit(number).alias("kind_no"), F.posexplode(kind.name)
            )
            for number, kind in enumerate(KINDS)
        ],
    )
    text = Window.partitionBy("row", "repo", "owner", "kind_no").orderBy("pos")
    before = text.rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("col.gap") + F.coalesce(F.col("col.size"), F.lit(0))).over(before)
    return (
        rows.select("*", end.cast("long").alias("end"))
        .where(F.col("col.size").isNotNull())
        .select(
            "row",
            "repo",
            "owner",
            "kind_no",
            (F.col("end") - F.col("col.size")).alias("start"),
            "end",
            F.col("col.value").alias("value"),
        )
        .where(_accepted())
        .withColumn("hash", F.sha2("value", 256))
        .drop("value")
    )


def _accepted():
    opaque = len(KINDS) - 1
    least = F.element_at(F.array(*[F.lit(k.least) for k in KINDS]), F.col("kind_no") + 1)
    letters = F.size(F.array_distinct(F.split("value", "")))
    mixed = F.col("value").rlike("[A-Za-z]") & (letters >= OPAQUE_LETTERS)
    return (F.length("value") >= least) & ((F.col("kind_no") != opaque) | mixed)


def ownership(candidates: DataFrame) -> DataFrame:
    """Distinct repositories and owners of each hash.

    Each hash is reduced to its distinct values before they meet, so a hash
    that stands in a third of all rows is no hot group.
    """
    some = candidates.select(
        "hash",
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("repo", "owner")],
    )
    pairs = some.distinct()
    return pairs.groupBy("hash").agg(
        F.countDistinct("repo").alias("repos"), F.countDistinct("owner").alias("owners")
    )


def _reported(found: DataFrame, copies: bool = False) -> DataFrame:
    """Per row of ``found`` with candidates: its spans in order.

    ``copies``: a row may stand there once per repository and owner.
    """
    candidates = _candidates(found)
    judged = candidates.drop("repo", "owner").join(ownership(candidates), "hash")
    example = (F.col("owners") > MAX_OWNERS) | (F.col("repos") > MAX_REPOSITORIES)
    names = F.array(*[F.lit(k.name) for k in KINDS])
    span = F.struct(
        "start",
        "kind_no",
        "end",
        F.element_at(names, F.col("kind_no") + 1).alias("kind"),
        (F.col("kind_no") < len(KINDS) - 1).alias("base"),
        "hash",
        "repos",
        "owners",
        F.when(example, "example").otherwise("live").alias("verdict"),
    )
    judged = judged.select("row", span.alias("span"))
    if copies:
        judged = judged.distinct()
    grouped = judged.groupBy("row").agg(F.array_sort(F.collect_list("span")).alias("spans"))
    # An opaque candidate counts where it is live and no base span covers part of it.
    rigid = F.filter("spans", lambda s: s["base"])
    return grouped.select("row", "spans", rigid.alias("rigid")).select(
        "row",
        F.filter(
            "spans",
            lambda s: s["base"]
            | (
                (s["verdict"] == "live")
                & ~F.exists("rigid", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
            ),
        ).alias("spans"),
    )


def _found(rows: DataFrame) -> DataFrame:
    """Matches of all kinds per row, written once: texts are read and searched once."""
    return staged(rows, "secrets")


def scan_secrets(
    df: DataFrame, id_col: str, text_col: str, repo_col: str, owner_col: str
) -> DataFrame:
    """Every row's id and its ``spans``: kind, place, hash, ownership counts and verdict."""
    rows = pick(df, id=id_col, text=text_col, repo=repo_col, owner=owner_col)
    found = _found(
        rows.withColumn("text", F.coalesce("text", F.lit(""))).select(
            F.monotonically_increasing_id().alias("row"),
            "id",
            "repo",
            "owner",
            *[_pieces(kind).alias(kind.name) for kind in KINDS],
        )
    )
    spans = _reported(found)
    none = F.array().cast(spans.schema["spans"].dataType)
    return found.join(spans, "row", "left").select(
        F.col("id").alias(id_col), F.coalesce("spans", none).alias("spans")
    )


def span_digest(spans):
    """Spans as kind:start:end, comma-joined, in their order."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def redact_secrets(
    df: DataFrame,
    text_col: str,
    repo_col: str,
    owner_col: str,
    length_col: str | None = None,
    mask: str = "<secret>",
) -> DataFrame:
    """The rows with every reported span replaced by ``mask``.

    ``length_col`` names a column of the text's length, if there is one to keep right.

    Rows without a match pass through as they are; only those with one are
    joined with their spans, by the hash of their text. Reported spans depend
    on the text and on corpus-wide counts alone, so equal texts share them.
    """
    names = df.columns
    plain = df.toDF(*[f"_{i}" for i in range(len(names))])
    at = {c: F.col(f"_{names.index(c)}") for c in (text_col, repo_col, owner_col)}
    text = f"_{names.index(text_col)}"
    loose = "|".join(f"(?:{kind.pattern})" for kind in KINDS)
    hit = F.coalesce(F.col(text).rlike(loose), F.lit(False))
    suspects = staged(plain.where(hit), "suspects")
    found = _found(
        suspects.select(at[text_col].alias("text"), at[repo_col].alias("repo"), at[owner_col].alias("owner"))
        .select(
            F.sha2("text", 256).alias("key"),
            "repo",
            "owner",
            *[_pieces(kind).alias(kind.name) for kind in KINDS],
        )
        # Copies of a text count for their owners but need their places once.
        .groupBy("key", "repo", "owner")
        .agg(*[F.first(kind.name).alias(kind.name) for kind in KINDS])
        .withColumnRenamed("key", "row")
    )
    spans = _reported(found, copies=True).select(F.col("row").alias("_key"), "spans")
    step = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    whole = F.col(text)

    def masked(done, span):
        keep = F.substring(whole, (done["at"] + 1).cast("int"), F.greatest(span["start"] - done["at"], F.lit(0)).cast("int"))
        put = F.when(span["start"] >= done["at"], F.concat(keep, F.lit(mask))).otherwise(F.lit(""))
        return F.struct(
            F.greatest(done["at"], span["end"]).alias("at"), F.concat(done["out"], put).alias("out")
        )

    rest = lambda done: F.concat(
        done["out"], F.substring(whole, (done["at"] + 1).cast("int"), F.length(whole))
    )
    redacted = F.when(F.size("spans") > 0, F.aggregate("spans", step, masked, rest)).otherwise(whole)
    columns = {text: redacted}
    if length_col:
        length = f"_{names.index(length_col)}"
        changed = F.length("_masked").cast(df.schema.fields[names.index(length_col)].dataType)
        columns[length] = F.when(F.size("spans") > 0, changed).otherwise(F.col(length))
    touched = (
        suspects.withColumn("_key", F.sha2(whole, 256))
        .join(spans, "_key", "left")
        .withColumn("_masked", columns.pop(text))
        .withColumns(columns)
        .withColumn(text, F.col("_masked"))
        .drop("_key", "spans", "_masked")
    )
    return plain.where(~hit).unionByName(touched).toDF(*names)
