"""Helpers that the operators share: tables, intermediate storage, Arrow mapping, connected components."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import reviewforge
from reviewforge.session import checkpoint_dir

from . import bpe

#: Rounds of a component search between changes of its hash.
RESALT = 4
#: Rows of one Arrow batch between the JVM and Python: documents are up to megabytes long.
ARROW_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def python_ready(spark: SparkSession) -> None:
    """Before a Python stage: bound its Arrow batches and send the package to the executors.

    Small batches let a worker hold few documents at once. The package goes as
    a zip through Spark's file server, once per Spark context, so the executors
    need no installation.
    """
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    context = spark.sparkContext
    if getattr(context, "_reviewforge_sent", None) is None:
        package = Path(reviewforge.__file__).parent
        target = Path(tempfile.mkdtemp(prefix="reviewforge-")) / "reviewforge.zip"
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
            for source in sorted(package.rglob("*.py")):
                z.write(source, source.relative_to(package.parent))
        context.addPyFile(str(target))
        context._reviewforge_sent = str(target)


_SOLE: dict[tuple, object] = {}


def sole(make: Callable, *args):
    """``make(*args)``, kept by a Python worker for all its tasks until another operator needs the worker.

    Workers outlive stages, so the operators of a pipeline run in the same ones;
    each would else add its memos and models to those of all before it.
    """
    name = (make.__module__, make.__qualname__, *args)
    if name not in _SOLE:
        forget()
        _SOLE[name] = make(*args)
    return _SOLE[name]


def forget() -> None:
    """Drop what ``sole`` keeps, and the tokenizer files read for it, and give the memory back to the system."""
    if _SOLE:
        _SOLE.clear()
        for read in (bpe.vocabulary, bpe.merge_table, bpe.library):
            read.cache_clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # not glibc
            pass


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared folder that the cluster names."""
    return f"{checkpoint_dir(spark).rstrip('/')}/reviewforge-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]], schema: str) -> DataFrame:
    """``fn`` turns the columns of a batch (Python lists) into the columns of the result."""
    python_ready(df.sparkSession)
    arrow = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch.to_pydict())
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def nearest(edges: DataFrame, *salt: int) -> DataFrame:
    """(node, up): the node of each neighbourhood, itself included, that has the smallest hash."""
    rank = lambda c: F.struct(F.xxhash64(F.col(c), *map(F.lit, salt)).alias("h"), F.col(c).alias("n"))
    both = edges.select("a", rank("b").alias("r")).unionByName(edges.select(F.col("b").alias("a"), rank("a").alias("r")))
    best = both.groupBy(F.col("a").alias("node")).agg(F.min("r").alias("r"))
    return best.select("node", F.least(F.col("r"), rank("node"))["n"].alias("up"))


def _contracted(edges: DataFrame, point: DataFrame) -> DataFrame:
    """The edges between the nodes that ``point`` (node, up) points at; a node that it lacks stays."""
    return (
        edges.join(point.select(F.col("node").alias("a"), F.col("up").alias("x")), "a", "left")
        .join(point.select(F.col("node").alias("b"), F.col("up").alias("y")), "b", "left")
        .select(F.coalesce("x", "a").alias("x"), F.coalesce("y", "b").alias("y"))
        .where("x <> y")
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .distinct()
    )


def _followed(first: DataFrame, then: DataFrame) -> DataFrame:
    """(node, up) by ``first`` and from there by ``then``, where it goes on."""
    return first.join(then.select(F.col("node").alias("up"), F.col("up").alias("root")), "up", "left").select("node", F.coalesce("root", "up").alias("up"))


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, up): one node of its component, for every node that has an edge.

    ``edges`` has long columns ``a`` and ``b``; direction, repeats and loops do
    not matter. In each round every node points at the node of its
    neighbourhood with the smallest hash, and the graph is contracted along
    these pointers. With one hash a star is gone in two rounds, however large;
    a new hash every few rounds breaks up what is left of chains, whatever
    their order of ids. The pointers are then composed, last round first. Minima are combined before the shuffle, so a
    node with very many neighbours is no hot group; the joins are plain
    equi-joins that AQE can split. Each round is written to the shared folder,
    which cuts the lineage.
    """
    pointers: list[DataFrame] = []
    edges = edges.where("a <> b")
    for turn in range(max_rounds):
        point = stored(nearest(edges, *[turn // RESALT] * (turn >= RESALT)), "pointers")
        if turn and point.isEmpty():
            break
        pointers.append(point)
        edges = stored(_contracted(edges, point), "edges")
    else:
        raise RuntimeError("the components did not settle")
    # A node that a round points at lives on in the next round, or is the root of its tree.
    roots = pointers[-1]
    for point in reversed(pointers[:-1]):
        roots = _followed(point, roots)
    return stored(roots, "roots") if len(pointers) > 1 else roots


def extended(known: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, up) of the components of ``known`` (node, up) with more ``edges``."""
    more = components(stored(_contracted(edges, known), "edges"))
    told = _followed(known, more)
    return told.unionByName(more.join(known.select("node"), "node", "left_anti"))
