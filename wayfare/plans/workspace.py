"""Staged tables of one pipeline run, each written once and then scanned.

The pipeline hands over through tables: raw trips (where a query reads them), cleaned trips, fitted
artifacts, feature matrix. A written table is a lineage cut that survives lost executors, and it gives every later
query a column-pruned, partition-pruned scan in place of repeated joins and de-duplication.
"""

import os
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from wayfare import schema as S
from wayfare import session
from wayfare.functions import trip
from wayfare.models import store
from wayfare.operators import impute, quality, split
from wayfare.plans import features, prepare
from wayfare.sources import sinks, star_schema, trips


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str, min_route_count: int = S.MIN_ROUTE_COUNT):
        self.spark = spark
        self.sf_dir = sf_dir
        self.min_route_count = min_route_count
        self.root = session.scratch_path(spark, "stages")
        self._tables: dict[str, DataFrame] = {}
        self._models: dict[str, object] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def close(self) -> None:
        """Delete this workspace's staged tables and models. Tables handed out before can't be read any more."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(os.path.dirname(self.root))
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        self._tables.clear()
        self._models.clear()
        for key in [k for k, ws in _open.items() if ws is self]:
            del _open[key]

    def read(self, name: str) -> DataFrame:
        """A staged table; its files are listed once and the listing is reused."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(self.path(name))
        return self._tables[name]

    @cached_property
    def months(self) -> list[trips.Month]:
        """Every month from the first to the last that the raw trips have files of."""
        rows = self.raw().select(S.SOURCE_YEAR, S.SOURCE_MONTH).distinct().collect()  # a row per month
        found = sorted((r[0], r[1]) for r in rows)
        return trips.months_between(found[0], found[-1]) if found else []

    def model(self, name: str, fit):
        """A fitted model, saved under its name the first time and loaded by whoever asks again."""
        if name not in self._models:
            store.save_model(fit(), self.path("models"), name)
            self._models[name] = store.load_model(self.spark, self.path("models"), name)
        return self._models[name]

    def forget_models(self) -> None:
        """Fit again what is asked for next."""
        self._models.clear()

    @cached_property
    def lines(self) -> int:
        """Order lines, about as many as trips: read from file footers."""
        return star_schema.table(self.spark, self.sf_dir, "lineitem").count()

    @cached_property
    def _raw_written(self) -> bool:
        with session.small_tasks(self.spark, self.lines):
            raw = star_schema.trips(self.spark, self.sf_dir)
            sinks.write_trips(raw, self.path("raw"), S.SOURCE_YEAR, S.SOURCE_MONTH)
        return True

    def raw(self) -> DataFrame:
        """Raw trips, partitioned by source month."""
        assert self._raw_written
        return self.read("raw")

    @cached_property
    def _clean_written(self) -> bool:
        # raw trips that no query has staged yet go to the rules without a table and a shuffle of their own
        raw = self.raw() if "_raw_written" in vars(self) else star_schema.trips(self.spark, self.sf_dir)
        with session.small_tasks(self.spark, self.lines):
            cleaned = prepare.prepare(quality.check_schema(raw)).select(*S.TRIP_COLUMNS)
            sinks.write_trips(sinks.with_pickup_month(cleaned), self.path("clean"), "year", "month", derive=trip.with_duration)
        return True

    def clean_unfilled(self) -> DataFrame:
        """Cleaned, distinct trips before imputation, partitioned by pickup month."""
        assert self._clean_written
        return self.read("clean")

    @cached_property
    def imputer(self) -> impute.Imputer:
        train, _ = split.by_cutoff(self.clean_unfilled(), star_schema.CUTOFF)
        return impute.fit_imputer(train)

    def clean(self) -> DataFrame:
        return self.imputer.apply(self.clean_unfilled())

    def train(self) -> DataFrame:
        return split.by_cutoff(self.clean(), star_schema.CUTOFF)[0]

    def test(self) -> DataFrame:
        return split.by_cutoff(self.clean(), star_schema.CUTOFF)[1]

    def zones(self) -> DataFrame:
        return star_schema.zones(self.spark, self.sf_dir)

    @cached_property
    def artifacts(self) -> features.Artifacts:
        train = self.train()
        with session.small_tasks(self.spark, self.lines):
            return features.fit(train, self.path("artifacts"), self.zones(), star_schema.REGION_CODES, self.min_route_count)

    def featured(self, df: DataFrame) -> DataFrame:
        return features.apply(df, self.artifacts)

    def train_features(self) -> DataFrame:
        return self.featured(self.train())

    def test_features(self) -> DataFrame:
        return self.featured(self.test())

    @cached_property
    def _matrix_written(self) -> bool:
        blocks = split.with_time_blocks(self.train())
        train = features.matrix(self.featured(blocks), features.FULL_FEATURES, [S.TARGET, "block"])
        test = features.matrix(self.test_features(), features.FULL_FEATURES)
        # trips are read month by month, so a task meets one block or two; folds then prune by block
        with session.small_tasks(self.spark, self.lines):
            sinks.write_parquet(train, self.path("train_matrix"), partition_by=("block",))
            sinks.write_parquet(test, self.path("test_matrix"))
        return True

    def train_matrix(self) -> DataFrame:
        """Training features, target and time block."""
        assert self._matrix_written
        return self.read("train_matrix")

    def test_matrix(self) -> DataFrame:
        assert self._matrix_written
        return self.read("test_matrix")


_open: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    """The workspace of a data directory within a running application."""
    key = (spark.sparkContext.applicationId, str(sf_dir))
    if key not in _open:
        _open[key] = Workspace(spark, str(sf_dir))
    return _open[key]
