"""Whether something is saved at a path, asked through Spark so that any store will do."""

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at a path of any store that Spark reads."""
    try:
        spark.read.text(path)
    except PySparkException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True
