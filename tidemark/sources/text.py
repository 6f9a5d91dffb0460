"""CSV, JSON, XML and HTML: landed text files and text columns to typed rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.scalars import parse_number


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    drop: Sequence[str] = (),
    rename: Mapping[str, str] | None = None,
) -> DataFrame:
    """CSV with a header and a given schema; columns are dropped and renamed by name."""
    df = spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)
    return df.drop(*drop).withColumnsRenamed(dict(rename or {}))


def append_sheets(
    spark: SparkSession, paths: Sequence[str], columns: Sequence[str], first_row: int = 7, target: str | None = None
) -> DataFrame:
    """Filled rows from line ``first_row`` on of every CSV sheet, united.

    Columns are taken by position from text sheets that may carry a title block above the
    data. A line's position is its distance from the smallest row id of the file's first
    block, so that large sheets stay split over many tasks; the title block must lie inside
    that first block. The target sheet itself is left out.
    """
    sources = [p for p in paths if p != target]
    lines = spark.read.text(sources).select(
        F.col("_metadata.file_path").alias("sheet"),
        (F.col("_metadata.file_block_start") == 0).alias("in_first"),
        F.monotonically_increasing_id().alias("row_id"),
        "value",
    )
    starts = lines.groupBy("sheet").agg(F.min(F.when(F.col("in_first"), F.col("row_id"))).alias("start"))
    below = ~F.col("in_first") | (F.col("row_id") - F.col("start") >= first_row - 1)
    filled = lines.join(starts, "sheet").where(below & (F.trim(F.regexp_replace("value", ",", "")) != ""))
    record = F.from_csv("value", F.lit(", ".join(f"`{c}` string" for c in columns)))
    return filled.select("sheet", record.alias("r")).select("sheet", "r.*")


# ---- JSON --------------------------------------------------------------------------------


def write_json_documents(df: DataFrame, path: str, mode: str = "append") -> None:
    """One JSON document per row, nested structs as nested objects."""
    df.write.mode(mode).json(path)


def validation_document(
    new_r2: Column, old_r2: Column, new_rmse: Column, old_rmse: Column, promote: Column, run_at: Column
) -> Column:
    """Nested result of a model comparison."""
    decision = F.when(promote == 1, "new model is better").otherwise("old model is kept")
    return F.struct(
        promote.alias("promotion_flag"),
        F.struct(decision.alias("decision"), (new_r2 - old_r2).alias("r2_gain")).alias("decision_details"),
        F.struct(new_r2.alias("r2_score"), new_rmse.alias("rmse")).alias("new_model_metrics"),
        F.struct(old_r2.alias("r2_score"), old_rmse.alias("rmse")).alias("old_model_metrics"),
        F.struct(run_at.alias("run_at")).alias("metadata"),
    )


METRICS_SCHEMA = "new_model_metrics struct<r2_score: double, rmse: double>"


def read_metrics(documents: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): r2 and rmse of each document, 0 where absent.

    Documents without the metrics section are rejected.
    """
    parsed = documents.withColumn("section", F.from_json(text, METRICS_SCHEMA).getField("new_model_metrics"))
    accepted = parsed.where(F.col("section").isNotNull()).select(
        *documents.columns,
        F.coalesce("section.r2_score", F.lit(0.0)).alias("r2"),
        F.coalesce("section.rmse", F.lit(0.0)).alias("rmse"),
    )
    return accepted, parsed.where(F.col("section").isNull()).select(*documents.columns)


# ---- XML ---------------------------------------------------------------------------------

# fixed values: element and attribute names of an exchange-rate list
RATE_SCHEMA = (
    "Exrate array<struct<_CurrencyCode: string, _CurrencyName: string, _Buy: string, _Transfer: string, _Sell: string>>"
)


def exchange_rates(documents: DataFrame, xml: str, base_date: str) -> DataFrame:
    """(code, name, buy, transfer, sell, base_date) from XML rate lists in column ``xml``.

    ``-`` means no quote; thousands commas are removed.
    """
    rates = documents.select(base_date, F.explode(F.from_xml(xml, RATE_SCHEMA).getField("Exrate")).alias("r"))
    return rates.select(
        F.trim("r._CurrencyCode").alias("code"),
        F.trim("r._CurrencyName").alias("name"),
        parse_number(F.col("r._Buy")).alias("buy"),
        parse_number(F.col("r._Transfer")).alias("transfer"),
        parse_number(F.col("r._Sell")).alias("sell"),
        base_date,
    )


def read_exchange_rate_files(spark: SparkSession, path: str) -> DataFrame:
    """Exchange rates of landed XML files, one row per rate element, with the file path."""
    schema = "_CurrencyCode string, _CurrencyName string, _Buy string, _Transfer string, _Sell string"
    rows = spark.read.option("rowTag", "Exrate").schema(schema).xml(path)
    return rows.select(
        F.trim("_CurrencyCode").alias("code"),
        F.trim("_CurrencyName").alias("name"),
        *[parse_number(F.col(f"_{c}")).alias(c.lower()) for c in ["Buy", "Transfer", "Sell"]],
        F.col("_metadata.file_path").alias("file_path"),
    )


# ---- HTML --------------------------------------------------------------------------------


def element_texts(html: Column, tag: str) -> Column:
    """Text of every ``tag`` element, inner tags removed."""
    found = F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>"), F.lit(1))
    return F.transform(found, lambda x: F.trim(F.regexp_replace(x, "<[^>]*>", "")))


# fixed values: elements without an end tag
VOID_ELEMENTS = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _ClassTexts(HTMLParser):
    """All text inside the elements of each class, in order of their start."""

    def __init__(self, classes: Sequence[str]):
        super().__init__(convert_charrefs=True)
        self.classes = {name: i for i, name in enumerate(classes)}
        self.found: list[list[list[str]]] = [[] for _ in classes]
        self.open: list[tuple[str, list[list[str]]]] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        texts: list[list[str]] = []
        for name in dict.fromkeys((dict(attrs).get("class") or "").split()):
            if name in self.classes:
                texts.append([])
                self.found[self.classes[name]].append(texts[-1])
        if tag not in VOID_ELEMENTS:
            self.open.append((tag, texts))

    def handle_endtag(self, tag: str) -> None:
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                del self.open[depth:]
                return

    def handle_data(self, data: str) -> None:
        for _, texts in self.open:
            for text in texts:
                text.append(data)


def class_texts(html: Column, classes: Sequence[str]) -> Column:
    """An array for each class: the texts of the elements that have it, nested elements included."""

    @F.pandas_udf("array<array<string>>")
    def texts(pages: pd.Series) -> pd.Series:
        out = []
        for page in pages:
            parser = _ClassTexts(classes)
            parser.feed(page or "")
            parser.close()
            out.append([["".join(text).strip() for text in found] for found in parser.found])
        return pd.Series(out)

    return texts(html)


def html_table_rows(
    pages: DataFrame, html: str, columns: Sequence[str], row_tag: str = "tr", cell_tag: str = "td"
) -> DataFrame:
    """One row per ``row_tag`` element with the texts of its cells as named columns.

    Rows without cells (headers) are dropped; cells beyond a row's end are null.
    """
    rest = [c for c in pages.columns if c != html]
    pattern = F.lit(rf"(?is)<{row_tag}(?:\s[^>]*)?>(.*?)</{row_tag}>")
    rows = pages.select(*rest, F.posexplode(F.regexp_extract_all(html, pattern, F.lit(1))).alias("row_index", "row"))
    cells = rows.withColumn("cells", element_texts(F.col("row"), cell_tag)).where(F.size("cells") > 0)
    return cells.select(*rest, "row_index", *[F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(columns)])


def html_class_rows(pages: DataFrame, html: str, classes: Sequence[str]) -> DataFrame:
    """Texts of several classes, put side by side by position; shorter lists end in nulls."""
    rest = [c for c in pages.columns if c != html]
    found = pages.select(*rest, class_texts(F.col(html), list(classes)).alias("_texts"))
    zipped = F.arrays_zip(*[F.col("_texts")[i].alias(c) for i, c in enumerate(classes)])
    rows = found.select(*rest, F.posexplode(zipped).alias("row_index", "r"))
    return rows.select(*rest, "row_index", *[F.col("r").getField(c).alias(c) for c in classes])
