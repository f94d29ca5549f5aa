"""Send this package to the executors, so that Python tasks find it wherever they run."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from tillhouse.session import scratch_path

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Once per application: put the package as a zip file into the shared folder and on the path of Python tasks."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    jvm = context._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{scratch_path(spark, 'package')}/{root.name}.zip")
    out = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path)
    out.write(data.getvalue())
    out.close()
    context.addPyFile(path.toString())
    _shipped.add(context.applicationId)
