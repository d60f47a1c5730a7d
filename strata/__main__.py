"""``python -m strata manifest.yml [base path]``: run a manifest and print the layer report."""

import sys

from pyspark.sql import SparkSession

from strata.plans import manifest
from strata.session import RECOMMENDED_CONF


def main(arguments: list[str]) -> int:
    if not 1 <= len(arguments) <= 2:
        print(__doc__, file=sys.stderr)
        return 2
    builder = SparkSession.builder.appName("strata")
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    manifest.run(spark, *arguments)
    manifest.report(spark, arguments[0]).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
