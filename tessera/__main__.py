"""python -m tessera --input_path slides.parquet --output_path out ..: runs the plan over a table of slide headers.

The table has the columns of schema.SLIDES. For readers that need the files' bytes (ppm), --input_path is a folder with that
table in slides.parquet beside the rasters, told apart by slide_id.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from . import schema
from .config import RunConfig
from .plans import pipeline
from .sources import slides


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> dict[str, str]:
    config = RunConfig.from_args(args)
    spark = spark or SparkSession.builder.appName("tessera").getOrCreate()
    if config.reader == "ppm":
        table = spark.read.schema(schema.SLIDES).parquet(f"{config.input_path}/slides.parquet")
        table = table.join(slides.raster_slides(spark, config.input_path).select("slide_id", "content"), "slide_id")
    else:
        table = spark.read.schema(schema.SLIDES).parquet(config.input_path)
    out = pipeline.execute(table, config)
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main()
