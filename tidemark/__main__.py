"""python -m tidemark WIDE_CSV OUT_FOLDER"""

import sys

from pyspark.sql import SparkSession

from tidemark.plans.reports import write_all

if __name__ == "__main__":
    if len(sys.argv) != 3:
        sys.exit(__doc__)
    write_all(SparkSession.builder.appName("tidemark").getOrCreate(), sys.argv[1], sys.argv[2])
