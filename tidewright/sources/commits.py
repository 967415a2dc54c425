"""Several products committed at once: readers see all of a run's partitions or none.

A run writes its rows below a version of its own, next to those that readers use. A manifest then names, for each product and
partition, the version that holds it: the manifest before, with the run's partitions replaced. Manifests are numbered, and one
appears under its number by a rename, which fails if another run was faster. So a run that fails, or loses, leaves what was
there, and its rows are unreferenced until they are swept.

A manifest has a line for each partition (a day of a source), which is what the driver holds.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFESTS, DATA, VERSION = "_manifests", "_data", "_version"


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _number(spark: SparkSession, root: str) -> int:
    """The number of the current manifest, 0 before the first."""
    at, fs = _fs(spark, f"{root}/{MANIFESTS}")
    if not fs.exists(at):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)


def manifest(spark: SparkSession, root: str) -> dict[str, dict[str, str]]:
    """product -> partition -> version, as last committed."""
    n = _number(spark, root)
    if not n:
        return {}
    lines = spark.read.option("wholetext", True).text(f"{root}/{MANIFESTS}/{n:012d}.json").first()
    return json.loads(lines[0])


def _publish(spark: SparkSession, root: str, number: int, content: dict) -> None:
    draft, fs = _fs(spark, f"{root}/{MANIFESTS}/{uuid.uuid4().hex}.draft")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    out.close()
    final, _ = _fs(spark, f"{root}/{MANIFESTS}/{number:012d}.json")
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise RuntimeError(f"manifest {number} was committed by another run")


def commit(root: str, products: Mapping[str, tuple[DataFrame, list[str]]]) -> int:
    """Replace the partitions that the products (name -> rows and partition columns) have rows of, all at once; the number of
    the new manifest. A product without rows changes nothing. An error leaves the committed state as it was."""
    spark = next(iter(products.values()))[0].sparkSession
    number = _number(spark, root) + 1
    content, version = manifest(spark, root), uuid.uuid4().hex
    for name, (rows, by) in products.items():
        folder = f"{root}/{DATA}/{name}/{VERSION}={version}"
        rows.repartition(*by).write.partitionBy(*by).parquet(folder)
        written = spark.read.schema(rows.schema).parquet(folder)
        coded = F.replace(F.input_file_name(), F.lit("+"), F.lit("%2B"))  # names of files come with escapes
        place = F.regexp_extract(F.url_decode(coded), rf"{VERSION}={version}/(.*)/[^/]*$", 1)
        found = [r.place for r in written.select(place.alias("place")).distinct().collect()]  # one for each partition
        content[name] = content.get(name, {}) | dict.fromkeys(found, version)
    _publish(spark, root, number, content)
    return number


def committed(spark: SparkSession, root: str, name: str, schema: StructType) -> DataFrame:
    """The rows of a product as last committed, partition columns last; none before its first commit."""
    places = manifest(spark, root).get(name, {})
    if not places:
        return spark.createDataFrame([], schema)
    base = f"{root}/{DATA}/{name}"
    paths = [f"{base}/{VERSION}={v}/{p}" for p, v in sorted(places.items())]
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)


def swept(spark: SparkSession, root: str) -> int:
    """Delete the versions of products that the current manifest does not name; how many. Not while another run commits."""
    used, gone = manifest(spark, root), 0
    at, fs = _fs(spark, f"{root}/{DATA}")
    for product in fs.listStatus(at) if fs.exists(at) else []:
        kept = set(used.get(product.getPath().getName(), {}).values())
        for v in fs.listStatus(product.getPath()):
            if v.getPath().getName().partition("=")[2] not in kept:
                gone += fs.delete(v.getPath(), True)
    return gone
