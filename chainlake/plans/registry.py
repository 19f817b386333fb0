"""The list of registered queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainlake.session import prepare
from chainlake.sources import views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Dates, wide numbers and nested values as text, so that results of different
    engines compare value by value."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DateType, T.DecimalType)):
            c = c.cast("string")
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            c = F.array_join(c, "|")
        elif isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            c = F.to_json(c)
        elif isinstance(f.dataType, T.BinaryType):
            c = F.lower(F.hex(c))
        out.append(c.alias(f.name))
    return df.select(*out)


def with_views(sql: str, names: tuple[str, ...]) -> str:
    """Prefix a statement with the views it reads."""
    if not names:
        return sql.strip()
    parts = ", ".join(f"{n} as ({views.ansi(n)})" for n in names)
    body = sql.strip()
    for start in ("with recursive ", "with "):
        if body.lower().startswith(start):
            return f"{start}{parts}, {body[len(start):]}"
    return f"with {parts} {body}"


def query(name: str, sql: str | None = None, reads: tuple[str, ...] | str = ()):
    """Register ``fn(src)`` under a name; ``src`` gives views and tables by name."""
    reads = (reads,) if isinstance(reads, str) else reads

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(Source(prepare(spark), sf_dir)))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql, reads)
        return fn

    return register


class Source:
    """Input of a registered query."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def view(self, name: str) -> DataFrame:
        return views.view(self.spark, self.sf_dir, name)

    def table(self, name: str) -> DataFrame:
        return views.all_cores(views.table(self.spark, self.sf_dir, name))

    def stream(self, name: str) -> DataFrame:
        """A view's rows as a stream over the table's files."""
        base = views.VIEWS[name][0]
        # A pattern, as a stream takes no single file.
        path = f"{self.sf_dir}/{base}[.]parquet"
        still = views.table(self.spark, self.sf_dir, base)
        rows = self.spark.readStream.schema(still.schema).option("maxFilesPerTrigger", 64).parquet(path)
        return views.shape(views.all_cores(rows, still), name)
