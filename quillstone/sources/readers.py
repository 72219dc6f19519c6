"""Scans: CSV and Parquet batches, latest and ranged batch selection, XML records, seed SQL, remote pages, databases."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Mapping, Sequence

import warnings

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.functions.text import dict_cell_to_json, float_int, pipe_split
from quillstone.runtime import cut


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str) -> DataFrame:
    """CSV with a header, quoted cells over several lines, doubled quotes; empty cells are null. A byte-order mark goes."""
    return spark.read.csv(path if isinstance(path, str) else list(path), header=True, schema=schema, multiLine=True, quote='"', escape='"', mode="PERMISSIVE")


def is_true(flag: Column) -> Column:
    return F.coalesce(F.lower(F.trim(flag)) == "true", F.lit(False))


def targets(rows: DataFrame) -> DataFrame:
    """Target rows that are switched on."""
    return rows.where(is_true(F.col("is_target")))


def latest(rows: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Rows of the batch with the greatest name; pruned to its partition where `batch` is one."""
    top = rows.agg(F.max(batch).alias("_top"))
    return rows.join(F.broadcast(top), F.col(batch) == F.col("_top"), "left_semi")


def batches(rows: DataFrame, batch: str = "batch_id", since: str | None = None, exactly: str | None = None) -> DataFrame:
    """Rows of one batch, of those from `since` on, or all. Raises if both are asked for."""
    if since and exactly:
        raise ValueError("since and exactly cannot be used together")
    if exactly:
        return rows.where(F.col(batch) == exactly)
    return rows.where(F.col(batch) >= since) if since else rows


def read_batches(spark: SparkSession, root: str, since: str | None = None, exactly: str | None = None) -> DataFrame:
    """Parquet below `root`/batch=.../, with the batch as column, only the partitions asked for."""
    return batches(spark.read.option("basePath", root).parquet(root), "batch", since, exactly)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Parquet at `path`, or an empty table where there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def union_batches(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def with_fallback(first: Callable[[], DataFrame], second: Callable[[], DataFrame], errors: tuple[type[Exception], ...] = (Exception,)) -> DataFrame:
    """The first table, or the second, with a warning, where the first can't be read. The first is read whole within
    the attempt and kept, so that an error in any part of it counts; meant for taxonomies and the like."""
    try:
        return cut(first())
    except errors as e:
        warnings.warn(f"first source failed, the second stands in: {str(e).splitlines()[0][:200]}", stacklevel=2)
        return second()


def read_database(spark: SparkSession, url: str, query: str, key: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 8) -> DataFrame:
    """A query over JDBC, in parts over a numeric key where bounds are given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) q")
    if key and bounds:
        reader = reader.options(partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=parts)
    return reader.load()


def seed_rows(sql_text: Column, columns: int) -> Column:
    """array<array<string>> of the VALUES rows in SQL text: the quoted cells of each."""
    row = r"\(\s*" + r"\s*,\s*".join([r"'((?:[^']|'')*)'"] * columns) + r"[^)]*\)"
    return F.transform(F.regexp_extract_all(sql_text, F.lit(f"({row})"), F.lit(1)), lambda r: F.transform(F.slice(F.regexp_extract_all(r, F.lit(r"'((?:[^']|'')*)'"), F.lit(1)), 1, columns), lambda c: F.replace(c, F.lit("''"), F.lit("'"))))


# Fixed value: where a paper is read, before its id.
PAPER_URL = "https://pubmed.ncbi.nlm.nih.gov/"
_AUTHOR = "struct<LastName:string,ForeName:string,CollectiveName:string>"
ARTICLE = (
    "struct<MedlineCitation:struct<PMID:string,Article:struct<ArticleTitle:string,Journal:struct<Title:string,JournalIssue:struct<PubDate:struct<Year:string,MedlineDate:string>>>,"
    f"Abstract:struct<AbstractText:array<struct<_VALUE:string,_Label:string>>>,AuthorList:struct<Author:array<{_AUTHOR}>>,ELocationID:array<struct<_VALUE:string,_EIdType:string>>>>,"
    "PubmedData:struct<ArticleIdList:struct<ArticleId:array<struct<_VALUE:string,_IdType:string>>>>>"
)


#: Marks of style and formulas inside running text, whose own text belongs to it.
_INLINE = r"</?(?:i|b|u|em|strong|sub|sup|DispFormula|mml:\w+)(?:\s[^<>]*)?/?>"


def _text(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def parse_articles(xml: Column) -> Column:
    """struct of pmid, title, abstract_text, journal, publication_year, authors, doi, pmcid and source_url of one
    article element as text. Text of marks inside running text stays, the marks go. Labelled sections become 'LABEL: text' lines; a year that is no number comes from the
    free date; a collective author goes before a personal name; the first DOI and PMC id count."""
    # in a lambda the element is parsed once, not for each field
    return F.get(F.transform(F.array(F.from_xml(F.regexp_replace(xml, _INLINE, ""), ARTICLE, {"attributePrefix": "_", "valueTag": "_VALUE"})), _article), F.lit(0))


def _article(a: Column) -> Column:
    art = a["MedlineCitation"]["Article"]
    none = F.expr("cast(array() as array<string>)")
    section = lambda s: F.when(_text(s["_VALUE"]).isNotNull(), F.when(s["_Label"].isNotNull(), F.concat(s["_Label"], F.lit(": "), _text(s["_VALUE"]))).otherwise(_text(s["_VALUE"])))
    abstract = F.array_compact(F.coalesce(F.transform(art["Abstract"]["AbstractText"], section), none))
    author = lambda p: F.coalesce(_text(p["CollectiveName"]), F.when(_text(p["LastName"]).isNotNull() & _text(p["ForeName"]).isNotNull(), F.concat_ws(" ", _text(p["ForeName"]), _text(p["LastName"]))), _text(p["LastName"]))
    authors = F.array_compact(F.coalesce(F.transform(art["AuthorList"]["Author"], author), none))
    date = art["Journal"]["JournalIssue"]["PubDate"]
    year = F.coalesce(F.when(_text(date["Year"]).rlike(r"^\d+$"), _text(date["Year"])), F.when(F.substring(_text(date["MedlineDate"]), 1, 4).rlike(r"^\d{4}$"), F.substring(_text(date["MedlineDate"]), 1, 4))).try_cast("int")
    first = lambda items, tag, kind: F.try_element_at(F.filter(items, lambda x: x[tag] == kind), F.lit(1))["_VALUE"]
    joined = lambda items, sep: F.when(F.size(items) > 0, F.array_join(items, sep))
    pmid = _text(a["MedlineCitation"]["PMID"])
    return F.struct(
        pmid.alias("pmid"),
        _text(art["ArticleTitle"]).alias("title"),
        joined(abstract, "\n").alias("abstract_text"),
        _text(art["Journal"]["Title"]).alias("journal"),
        year.alias("publication_year"),
        joined(authors, "; ").alias("authors"),
        _text(first(art["ELocationID"], "_EIdType", "doi")).alias("doi"),
        _text(first(a["PubmedData"]["ArticleIdList"]["ArticleId"], "_IdType", "pmc")).alias("pmcid"),
        F.concat(F.lit(PAPER_URL), pmid, F.lit("/")).alias("source_url"),
    )


def fetch_pages(keys: DataFrame, column: str, fetch: Callable[[list[str]], list[str]], per_call: int = 200, pause: float = 0.34, callers: int = 1) -> DataFrame:
    """key, body: pages fetched for distinct keys, `per_call` to a request, with a pause after each, by `callers` tasks
    at once. `fetch` gets keys and returns as many bodies; without keys it is never called."""
    import time

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for at in range(0, len(pdf), per_call):
                some = pdf["key"].iloc[at : at + per_call].tolist()
                yield pd.DataFrame({"key": some, "body": fetch(some)})
                time.sleep(pause)

    return keys.select(F.col(column).alias("key")).where("key is not null").distinct().repartition(callers, "key").mapInPandas(run, "key string, body string")


def searched(rows: DataFrame, cell: str) -> Column:
    """Number of parts of a pipe-delimited cell that are not blank; 0 for null."""
    return F.coalesce(F.size(pipe_split(F.col(cell))), F.lit(0))


def search_ids(body: Column) -> Column:
    """The ids in the answer to a search; empty for an answer without any or that is no JSON."""
    return F.coalesce(F.from_json(body, "struct<esearchresult:struct<idlist:array<string>>>")["esearchresult"]["idlist"], F.array().cast("array<string>"))


def search(queries: DataFrame, column: str, ask: Callable[[list[str]], list[str]], limit: int | None = None, pause: float = 0.34) -> DataFrame:
    """key (the query text), pos, id: what a search service finds for distinct queries, at most `limit` ids each."""
    pages = fetch_pages(queries, column, ask, per_call=1, pause=pause)
    ids = search_ids(F.col("body"))
    return pages.select("key", F.posexplode(F.slice(ids, 1, limit) if limit else ids).alias("pos", "id"))


def chosen_batch(rows: DataFrame, batch: str = "batch_id", explicit: str | None = None, variable: str = "SILVER_BATCH_ID", env: Mapping[str, str] | None = None) -> DataFrame:
    """Rows of the batch asked for, else of the one the environment names, else of the latest."""
    name = explicit or (os.environ if env is None else env).get(variable)
    return batches(rows, batch, exactly=name) if name else latest(rows, batch)


def read_batch(spark: SparkSession, root: str, name: str, schema: T.StructType | str) -> DataFrame:
    """CSV below `root`/batch=`name`; raises FileNotFoundError if there is no such batch."""
    path = f"{root.rstrip('/')}/batch={name}"
    if not _files(spark, path):
        raise FileNotFoundError(path)
    return read_csv(spark, path, schema)


def _files(spark: SparkSession, pattern: str) -> list[tuple[str, int, int]]:
    """(path, size, time of change) of the files below a folder or fitting a pattern; none if there is no such place."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, todo = [], list(system.globStatus(path) or [])
    while todo:
        status = todo.pop()
        if status.isDirectory():
            todo += list(system.listStatus(status.getPath()))
        elif not status.getPath().getName().startswith(("_", ".")):
            found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return sorted(found)


def read_many(spark: SparkSession, pattern: str, schema: T.StructType | str, keep_names: bool = False) -> DataFrame:
    """All CSV files that fit a pattern as one table. Empty files are passed over, and so is a file whose header is not
    that of the schema, and a row that doesn't fit it; no file at all gives an empty table."""
    names = T.StructType.fromDDL(schema).names if isinstance(schema, str) else schema.names
    paths = [p for p, size, _ in _files(spark, pattern) if size > 0]
    if not paths:
        return spark.createDataFrame([], schema)
    # which files have the header, in one distributed pass
    heads = spark.read.text(paths, wholetext=False).withColumn("_file", F.input_file_name()).where(F.regexp_replace("value", "^\ufeff", "") == ",".join(names)).select("_file").distinct()
    good = [r["_file"] for r in heads.toLocalIterator()]
    if not good:
        return spark.createDataFrame([], schema)
    rows = spark.read.csv(good, header=True, schema=schema, multiLine=True, quote='"', escape='"', mode="DROPMALFORMED")
    return rows.withColumn("_file", F.input_file_name()) if keep_names else rows


def latest_file(spark: SparkSession, pattern: str, has: str, without: str = "error", suffix: str = ".csv") -> str:
    """The file changed last of those whose name holds `has`, not `without`, and ends on `suffix`; of several the one
    last by name. Raises FileNotFoundError if there is none."""
    fit = [(t, p) for p, _, t in _files(spark, pattern) if has in p and without not in p and p.endswith(suffix)]
    if not fit:
        raise FileNotFoundError(pattern)
    return max(fit)[1]


def latest_job(rows: DataFrame, key: str, order: Sequence[str], batch: str = "batch_job") -> DataFrame:
    """Rows of the greatest `batch`, the first of each key in the given order."""
    from quillstone.operators.aggregate import first_wins

    return first_wins(latest(rows, batch), [key], order)


def highest_wins(rows: DataFrame, key: str, code: str) -> DataFrame:
    """The row with the greatest `code` of each key; rows without a key go."""
    from quillstone.operators.aggregate import last_wins

    return last_wins(rows.where(F.col(key).isNotNull()), [key], [code])


def corpus(papers: DataFrame, text: str = "abstract_text", key: str = "pmid") -> DataFrame:
    """Papers with a key and a text that is not blank. `ordered` puts them in order at a sink."""
    return papers.where(F.col(key).isNotNull() & (F.trim(text) != ""))


def seed_ids(sql_text: Column, columns: int = 2) -> Column:
    """array<struct<id, cells>> of the VALUES rows in SQL text, numbered from 1 in order."""
    return F.transform(seed_rows(sql_text, columns), lambda r, i: F.struct((i + 1).alias("id"), r.alias("cells")))


# Fixed value: how a product number stands in the address of a product.
GOODS_NUMBER = r"goodsNo=([A-Za-z0-9]+)"


def product_links(rows: DataFrame, product: str = "product_id", url: str = "product_url", number: str = GOODS_NUMBER) -> DataFrame:
    """product_id, product_url and goods_no of the rows that have all three."""
    flat = rows.select(F.trim(product).alias("product_id"), F.trim(url).alias("product_url"))
    return flat.withColumn("goods_no", F.regexp_extract("product_url", number, 1)).where("product_id <> '' and product_url <> '' and goods_no <> ''")


def product_reviews(rows: DataFrame, product: str = "product_id", rating: str = "rating", count: str = "review_count", stats: str = "review_stats") -> DataFrame:
    """product_id, rating, review_count and review_stats of the rows with a product and a rating that is a number. A
    count that is none is 0; stats become JSON without their false values, null if none is left."""
    flat = rows.select(F.trim(product).alias("product_id"), F.trim(rating).try_cast("double").alias("rating"), F.coalesce(float_int(F.col(count)), F.lit(0)).alias("review_count"), dict_cell_to_json(F.col(stats)).alias("review_stats"))
    return flat.where("product_id <> '' and rating is not null")


def untyped(edges: DataFrame) -> DataFrame:
    """Edges with plain column names and types from headers as a loader has them: ":START_ID(X)" becomes start, ":END_ID(X)"
    end, "name:float" and "name:int" name as double and int."""

    def plain(c: str) -> Column:
        name, _, kind = c.rpartition(":")
        if not name:
            return F.col(f"`{c}`").alias({"START_ID": "start", "END_ID": "end"}.get(kind.split("(")[0], kind))
        kinds = {"float": "double", "int": "int", "boolean": "boolean"}
        return F.col(f"`{c}`").try_cast(kinds[kind]).alias(name) if kind in kinds else F.col(f"`{c}`").alias(name if kind.split("(")[0] == "ID" else c)

    return edges.select(*map(plain, edges.columns))


def ordered(rows: DataFrame, order: Sequence[Column | str], limit: int = 0) -> DataFrame:
    """Rows in order, the first `limit` of them (0 for all), which is a top-k and no sort of all rows."""
    out = rows.orderBy(*order)
    return out.limit(limit) if limit else out
