"""Registered queries: a Spark function and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Views over the given tables, in SQL that Spark and DuckDB read alike. Table,
# then select list; joins are spelled out where a view needs one.
TASKS = [
    "doc_id as index", "text as instruction", "lang", "source", "n_chars",
    """case doc_id % 6
        when 0 then null
        when 1 then '  '
        when 2 then concat(source, '/', lang, '/', doc_id)
        when 3 then concat(source, '//', doc_id, '.JPG')
        when 4 then concat('./', lang, '/', doc_id, '.webp')
        else concat(source, '/', doc_id, '.jpeg') end as output_path""",
    "64 + (n_chars * 37) % 4033 as w",
    "64 + (n_chars * 91) % 4033 as h",
    "case doc_id % 4 when 0 then null when 1 then 0 else doc_id % 50 end as steps",
    """case doc_id % 5 when 0 then 'qwen' when 1 then 'qwen_singleimg' when 2 then 'flux2'
        when 3 then 'unknown' else 'longcat' end as model_type""",
]
# Documents with a label count as done: literal paths, not computed by the code under test.
OUTPUTS = [
    """case documents.doc_id % 6
        when 2 then concat(source, '/', lang, '/', documents.doc_id, '.png')
        when 3 then concat(source, '/', documents.doc_id, '.jpg')
        when 4 then concat(lang, '/', documents.doc_id, '.webp.png')
        when 5 then concat(source, '/', documents.doc_id, '.jpeg')
        else concat(lpad(concat(documents.doc_id, ''), 6, '0'), '.png') end as path""",
    "documents.doc_id as done_id",
]
IMAGES = [
    "page_id as index", "url",
    """case page_id % 5
        when 0 then url
        when 1 then concat('["', url, '", "img/', page_id, '.png"]')
        when 2 then concat(url, ', /abs/', page_id, '.jpg,, ')
        when 3 then '[]'
        else concat('  rel/', page_id, '.webp ') end as input_images""",
    "page_id % 7 <> 0 as fetch_ok",
    "html",
]
LOG = [
    "event_id", "ts", "user_id as task", "event_id % 4 as endpoint",
    "event_type <> 'error' as ok",
    """case when event_type = 'error' then
        case event_id % 3 when 0 then 'E2001' when 1 then 'E2002' else 'E1004' end end as code""",
    """concat('2024-01-01 00:00:00 - [Rank ', event_id % 4, '] - genflow - INFO - [Process ',
        event_id % 4, '] Saved: ', event_id, '.png') as line""",
]
REQUESTS = [
    "conv_id * 1000 + turn as request_id", "conv_id", "turn", "text",
    """case turn % 5
        when 0 then concat('{"prompt": "p', conv_id, '", "n": 3, "size": "1024X768"}')
        when 1 then concat('{"prompt": "p', conv_id, '", "n": 0, "size": "auto"}')
        when 2 then '{"prompt": "", "size": "12x"}'
        when 3 then concat('{"prompt": "e', conv_id, '", "images": [{"image_url": "data:image/png;base64,aGk="}]}')
        else concat('{"prompt": "e', conv_id, '", "images": [{"file_id": "f', conv_id, '"}]}') end as body""",
    "case when turn % 5 >= 3 then 'edit' else 't2i' end as kind",
]
# Endpoint dimension: (endpoint, base_url, weight, rate_limit, n_keys).
ENDPOINTS = [
    (0, None, 1, 0, 2), (1, "http://p1/v1beta/", 2, 30, 2), (2, "http://p2//", 5, 60, 3), (3, "http://p3/v1", 8, 2, 2),
]
START_US = 1_704_067_200_000_000
# The log squeezed 100 times in time, so that rate limits bite.
FAST_US = f"{START_US} + ({{us}} - {START_US}) {{div}} 100"

VIEWS = {
    "tasks": f"select {', '.join(TASKS)} from documents",
    "outputs": f"select {', '.join(OUTPUTS)} from documents join labels on documents.doc_id = labels.doc_id",
    "images": f"select {', '.join(IMAGES)} from pages",
    "log": f"select {', '.join(LOG)} from events",
    "fast_log": f"select * exclude (ts), {FAST_US.format(us='epoch_us(ts)', div='//')} as t from log",
    "requests": f"select {', '.join(REQUESTS)} from conversations",
    "endpoints": "select * from (values " + ", ".join(
        "({}, {}, {}, {}, {})".format(e, "null" if u is None else f"'{u}'", w, r, k) for e, u, w, r, k in ENDPOINTS
    ) + ") e(endpoint, base_url, weight, rate_limit, n_keys)",
}
NEEDS = {"fast_log": ["log"]}


def sql(views: str, body: str) -> str:
    """``body`` with the named views in front."""
    names: list[str] = []
    for view in views.split():
        names += [v for v in [*NEEDS.get(view, []), view] if v not in names]
    start = ", ".join(f"{v} as ({VIEWS[v]})" for v in names)
    return f"with {start}, result as ({body}) select * from result"


class Tables:
    """The views as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def tasks(self) -> DataFrame:
        """With the file and row each task comes from."""
        return self.read("documents").selectExpr(
            *TASKS, "_metadata.file_path as _file", "_metadata.row_index as _row")

    def outputs(self) -> DataFrame:
        documents, labels = self.read("documents").alias("documents"), self.read("labels").alias("labels")
        return documents.join(labels, F.expr("documents.doc_id = labels.doc_id")).selectExpr(*OUTPUTS)

    def images(self) -> DataFrame:
        return self.read("pages").selectExpr(*IMAGES)

    def log(self) -> DataFrame:
        return self.read("events").selectExpr(*LOG)

    def fast_log(self) -> DataFrame:
        fast = FAST_US.format(us="unix_micros(cast(ts as timestamp))", div="div")
        return self.log().withColumn("ts", F.timestamp_micros(F.expr(fast)))

    def requests(self) -> DataFrame:
        return self.read("conversations").selectExpr(*REQUESTS)

    def endpoints(self) -> DataFrame:
        return self.spark.createDataFrame(
            ENDPOINTS, "endpoint bigint, base_url string, weight int, rate_limit int, n_keys int")


def query(name: str, oracle: str | None = None):
    """Register a function of :class:`Tables` under ``name``."""
    def add(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add
