"""Lines that several documents share, kept in one document only.

Lines are exploded, normalised and hashed; distinct documents are counted for
each hash; the positions of lines over the threshold go back to their document,
whose other lines are joined again by position. Only hashes, ids and positions
are shuffled for the count. Texts are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from silvermill.llm.text import WHITE, ascii_lower, free_names, hash128, whole_text


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


def _lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    text = whole_text(text_col)
    return (
        docs.select(
            F.col(id_col).alias("id"),
            F.xxhash64(text).alias("version"),
            F.posexplode(split_lines(text)).alias("pos", "line"),
        )
        .select("id", "version", "pos", line_key(F.col("line")).alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select("id", "version", "pos", hash128(F.col("key")).alias("key"))
    )


def shared_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    min_docs: int = 2, min_chars: int = 10,
) -> DataFrame:
    """One row per line key in `min_docs` documents or more: key, n_docs, keeper.

    The keeper is the smallest id; a null id counts as one document and keeps
    nothing if there is another.
    """
    return (
        _lines(docs, id_col, text_col, min_chars)
        .select("key", "id").distinct()
        .groupBy("key").agg(F.count("*").alias("n_docs"), F.min("id").alias("keeper"))
        .where(F.col("n_docs") >= min_docs)
    )


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 2,
    min_chars: int = 10,
    counts: tuple[str, str] | None = ("n_lines", "n_dropped"),
) -> DataFrame:
    """The same rows and columns, with shared lines gone from `text_col`.

    A key of `min_chars` code points or more that `min_docs` documents hold
    loses all its lines but those of the document with the smallest id. `counts`
    names two columns to add (lines before, lines dropped); columns of these
    names are replaced, other columns are left alone.

    A null text is one empty line and becomes an empty text. Rows that share an
    id are one document; each row stays and keeps or loses its lines alike. An
    empty table gives an empty table. Time grows with a text's length, however
    many lines it has.
    """
    shared = shared_lines(docs, id_col, text_col, min_docs, min_chars)
    lines = _lines(docs, id_col, text_col, min_chars)
    # the hash is one more join key, so that the join has exchanges of its own, of
    # which adaptive execution splits a line that very many documents have
    spread = F.xxhash64("key.a").alias("spread")
    own_id, version, gone, text_hash, own_lines = free_names(
        docs, "id", "version", "gone", "text_hash", "lines"
    )
    dropped = (
        lines.select("*", spread).join(shared.select("*", spread), ["key", "spread"])
        .where(~F.col("id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("id").alias(own_id), F.col("version").alias(version))
        .agg(F.collect_set("pos").alias(gone))
    )
    text = whole_text(text_col)
    rows = docs.withColumns({text_hash: F.xxhash64(text), own_lines: split_lines(text)})
    joined = rows.drop(text_col).join(
        dropped,
        rows[id_col].eqNullSafe(F.col(own_id)) & (F.col(text_hash) == F.col(version)),
        "left",
    )
    places = F.sequence(F.lit(0), F.size(own_lines) - 1)
    kept = F.transform(
        F.array_except(places, F.col(gone)), lambda i: F.get(F.col(own_lines), i)
    )
    new = {
        text_col: F.array_join(
            F.when(F.col(gone).isNull(), F.col(own_lines)).otherwise(kept), "\n"
        )
    }
    names = list(docs.columns)
    if counts:
        new[counts[0]] = F.size(own_lines).cast("long")
        lost = F.when(F.col(gone).isNull(), F.lit(0)).otherwise(F.size(gone))
        new[counts[1]] = lost.cast("long")
        names += [name for name in counts if name not in names]
    return joined.select(*[new.get(name, F.col(f"`{name}`")).alias(name) for name in names])
