"""Line dedup: lines that many documents share stay in one of them only.

Long lines are normalised, hashed and exploded as slim rows (document, position, hash). A hash is
kept with the number of its documents and their largest id; the positions that go are gathered per
document, and each text is put together again by position from the lines that stay.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name
from tidemark.session import cut_lineage

#: Fixed value: ASCII white space, 0x20 and 0x09 to 0x0D.
SPACE = " \t\n\x0b\f\r"
HOT = 1000  # lines that fill a share of one in so many of the rows are joined without moving those


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other letters as they are."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))


def keys_of(text: Column) -> Column:
    """Array of the normalised lines of a text."""
    lines = F.split(lower_ascii(text), "\n", -1)
    return F.transform(lines, lambda line: F.btrim(line, F.lit(SPACE)))


def line_documents(lines: DataFrame) -> DataFrame:
    """(hash, n_documents, keeper): number of documents and the largest id of each hash of (hash, id).

    A pair of line and document counts once, wherever it is repeated; pairs are spread by both, so
    that a line of a third of all documents is added up in many tasks before its counts meet. All
    rows without id are one document, which comes before all others.
    """
    pairs = lines.groupBy("hash", "id").agg(F.lit(1).alias("one"))
    return pairs.groupBy("hash").agg(F.count("*").alias("n_documents"), F.max("id").alias("keeper"))


def drop_shared_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", least_length: int = 40, least_documents: int = 5) -> DataFrame:
    """``docs`` with shared lines cut out of ``text``, and with n_lines and n_dropped as longs.

    A line's key is the line without ASCII white space at both ends and with A-Z in lower case.
    Keys of ``least_length`` code points or more that occur in ``least_documents`` documents or more
    lose all their lines except in the document with the largest id. The other lines stay as they
    are, joined by line feeds; n_lines counts those before. A null or empty text is one empty line
    and becomes the empty text. Rows that repeat an id are one document, and each of them keeps or
    loses its lines with it; rows without id are one document, which keeps a line only if no
    other has it. No rows give no rows. All other columns stay; columns named n_lines or
    n_dropped make the new ones take an underscore.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    mark = F.xxhash64(content)  # tells rows of one id apart
    keys = docs.select(F.col(id).alias("id"), mark.alias("mark"), F.posexplode(keys_of(content)).alias("position", "key"))
    long = keys.where(F.char_length("key") >= least_length)
    lines = cut_lineage(long.select("id", "mark", "position", F.unhex(F.md5("key")).alias("hash")))
    shared = cut_lineage(line_documents(lines).where(F.col("n_documents") >= least_documents))
    # the lines of a thousandth of all rows are a thousand hashes at most: they go to every task, so that
    # their rows stay where they are; the others are joined by hash
    often = F.col("n_documents") * HOT >= lines.count()
    hot, others = F.broadcast(shared.where(often).select("hash", "keeper")), shared.where(~often).select("hash", "keeper")
    met = lines.join(hot, "hash").unionByName(lines.join(hot.select("hash"), "hash", "left_anti").join(others, "hash"))
    gone = met.where(~F.col("id").eqNullSafe(F.col("keeper")))
    positions = gone.groupBy("id", "mark").agg(F.collect_set("position").alias("positions"))
    key = F.struct("id", "mark")  # structs are equal if their nulls are
    positions = positions.select(key.alias("_of"), "positions")

    own, at, cut, split = (free_name(docs, name) for name in ("of", "positions", "cut", "split"))
    marked = docs.withColumn(own, F.struct(F.col(id).alias("id"), mark.alias("mark")))
    met = marked.join(positions.withColumnsRenamed({"_of": cut, "positions": at}), F.col(own) == F.col(cut), "left")
    number = F.size(F.split(content, "\n", -1)).cast("long")

    def left_over(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(at))
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")

    # the split text is bound to a lambda, so that it is computed once for all positions
    rest = F.element_at(F.transform(F.array(F.split(content, "\n", -1)), left_over), 1)
    out = met.withColumns(
        {
            free_name(docs, "n_lines"): number,
            free_name(docs, "n_dropped"): F.coalesce(F.size(at), F.lit(0)).cast("long"),
            split: F.when(F.col(at).isNull(), content).otherwise(rest),
        }
    )
    return out.withColumn(text, F.col(split)).drop(own, at, cut, split)
