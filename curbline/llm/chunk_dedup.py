"""Exact duplicates by recipes of content-defined chunks.

A text without its white space is cut where its own characters say so, so equal passages give
equal chunks wherever they stand. Distinct chunks are brought together once and get verified
identifiers; a document is then just its ordered list of identifiers (its recipe), and documents
are compared by recipe. Long documents are never moved to be compared.

Identifiers are 64-bit digests of chunks. Two different chunks under one digest are found by
comparing the chunks themselves, and such digests are told apart by a number, so equal recipes
always mean equal texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import BLANK, cut

SHORTEST, LONGEST = 512, 4096  # characters of a chunk


def _cut_set(offset: int, high: bool) -> str:
    """A sixteenth of the characters as a class: below U+0100 by residue, from there to U+FFFF
    64 of every 1024."""
    if not high:
        return "[" + "".join(f"\\x{{{c:x}}}" for c in range(0x21, 0x100) if c % 16 == offset) + "]"
    firsts = range(0x400 + 64 * offset, 0xD800, 0x400)
    return "[" + "".join(f"\\x{{{c:x}}}-\\x{{{c + 63:x}}}" for c in firsts) + "]"


def cut_pattern(shortest: int = SHORTEST, longest: int = LONGEST) -> str:
    """A chunk ends behind a character of one set and one of another, else at its longest. The
    classes of higher characters are many ranges, so they are tried behind a test for one range."""
    ends = (
        f"(?:{_cut_set(3, False)}{_cut_set(5, False)}"
        f"|(?=[\\x{{100}}-\\x{{ffff}}]){_cut_set(3, True)}{_cut_set(5, True)})"
    )
    return f"(?s).{{{shortest - 2},{longest - 2}}}?{ends}|(?s).{{1,{longest}}}"


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{BLANK}+", "")


def chunks(norm: Column, shortest: int = SHORTEST, longest: int = LONGEST) -> Column:
    return F.regexp_extract_all(norm, F.lit(cut_pattern(shortest, longest)), F.lit(0))


def chunk_digest(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def _variants(docs: DataFrame, clashing: DataFrame, text: str, id_col: str, digest, sizes):
    """The numbers of clashing chunks in every document that has one, in order."""
    norm = normalised(F.col(text))
    pieces = docs.select(
        F.col(id_col).alias("doc_id"),
        F.sha2(norm, 256).alias("text_sha256"),
        F.posexplode(chunks(norm, *sizes)).alias("pos", "chunk"),
    ).withColumn("digest", digest(F.col("chunk")))
    numbers = (
        pieces.select("digest", "chunk")
        .join(clashing, "digest", "left_semi")
        .distinct()
        .withColumn("variant", F.dense_rank().over(Window.partitionBy("digest").orderBy("chunk")))
    )
    return (
        pieces.join(numbers, ["digest", "chunk"])
        .groupBy("doc_id", "text_sha256")
        .agg(F.sort_array(F.collect_set(F.struct("pos", "variant"))).alias("variants"))
    )


def recipes(
    docs: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    digest: Callable[[Column], Column] = chunk_digest,
    sizes: tuple[int, int] = (SHORTEST, LONGEST),
) -> DataFrame:
    """One row per document: row, doc_id, n_points (of the original text), text_sha256, recipe
    (ordered chunk identifiers) and variants (empty unless two chunks share a digest)."""
    norm = normalised(F.col(text))
    rows = cut(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.length(F.coalesce(F.col(text), F.lit(""))).alias("n_points"),
            norm.alias("norm"),
        ).select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "n_points",
            F.sha2("norm", 256).alias("text_sha256"),
            F.transform(chunks(F.col("norm"), *sizes), digest).alias("recipe"),
        )
    )
    clashing = cut(
        docs.select(F.explode(chunks(norm, *sizes)).alias("chunk"))
        .select(digest(F.col("chunk")).alias("digest"), "chunk")
        .distinct()
        .groupBy("digest")
        .count()
        .where("count > 1")
        .select("digest")
    )
    if clashing.isEmpty():
        return rows.withColumn("variants", F.array().cast("array<struct<pos:int,variant:int>>"))
    told = _variants(docs, clashing, text, id_col, digest, sizes)
    same = rows.doc_id.eqNullSafe(told.doc_id) & (rows.text_sha256 == told.text_sha256)
    none = F.array().cast("array<struct<pos:int,variant:int>>")
    return rows.join(told, same, "left").select(
        *(rows[c] for c in rows.columns), F.coalesce(told.variants, none).alias("variants")
    )


def _order(df_col: Callable[[str], Column]) -> Column:
    """Sorts the row that stays first: most code points, smallest id (none last), any one of
    rows alike."""
    return F.struct(
        (-df_col("n_points")).alias("less"),
        df_col("doc_id").isNull().alias("no_id"),
        df_col("doc_id").alias("doc_id"),
        df_col("row").alias("row"),
    )


def exact_groups(docs: DataFrame, **options) -> DataFrame:
    """Every document with its group of equal texts.

    Texts are equal when the same after deleting white space; null counts as empty. Per row:
    doc_id, keep_id, group_size, kept, text_sha256. Of repeated rows (one id, one text) a single
    one is kept; a row without id stays only where its group has no better one, then keep_id is
    null. Only the id and text columns are read, so other columns may have any name. No rows give
    no rows.
    """
    rows = recipes(docs, **options)
    groups = rows.groupBy("recipe", "variants").agg(
        F.count(F.lit(1)).alias("group_size"), F.min(_order(F.col)).alias("keep")
    )
    return rows.join(groups, ["recipe", "variants"]).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        "text_sha256",
    )


def deduplicate(docs: DataFrame, text: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """The documents that stay, with all their columns.

    Who stays is decided on identifiers alone. The full rows are moved once, to meet the list of
    those that stay, and of rows alike in id, length and text one is taken where they then stand, by a
    hash of all columns that have one (maps have none).
    """
    rows = recipes(docs, text, id_col, **options)
    stay = (
        rows.groupBy("recipe", "variants")
        .agg(F.min(F.struct(*_parts(), "text_sha256")).alias("keep"))
        .select(
            F.col("keep.doc_id").alias("stay_id"),
            F.col("keep.less").alias("stay_less"),
            F.col("keep.text_sha256").alias("stay_text"),
        )
    )
    # Plain keys, so that the last step finds the rows already together.
    keys = {"text_key": "stay_text", "less_key": "stay_less", "id_key": "stay_id"}
    named = stay.select(
        "stay_text", "stay_less", F.col("stay_id").isNull().alias("stay_none"),
        F.coalesce(F.col("stay_id").cast("string"), F.lit("")).alias("stay_id"),
    )
    plain = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind]
    keyed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole"),
        F.xxhash64(*plain).alias("tie"),
        F.sha2(normalised(F.col(text)), 256).alias("text_key"),
        (-F.length(F.coalesce(F.col(text), F.lit("")))).alias("less_key"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id_key"),
        F.col(id_col).isNull().alias("none_key"),
    )
    on = [F.col(a) == F.col(b) for a, b in (*keys.items(), ("none_key", "stay_none"))]
    return (
        keyed.join(named, on, "left_semi")
        .groupBy(*keys, "none_key")
        .agg(F.min_by("whole", "tie").alias("whole"))
        .select("whole.*")
    )


def _parts() -> list[Column]:
    return [
        (-F.col("n_points")).alias("less"),
        F.col("doc_id").isNull().alias("no_id"),
        F.col("doc_id"),
    ]
