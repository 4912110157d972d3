import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from adtally import schemas  # noqa: E402
from adtally.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("adtally-tests", cores=4, memory="4g", shuffle_partitions=4)
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session


@pytest.fixture
def events(spark):
    """Build an event frame from dicts; missing columns are NULL, the type defaults to deposit."""
    from pyspark.sql import functions as F

    def build(rows):
        texts = [{k: None if v is None else str(v) for k, v in {"event_type": "deposit", **r}.items()} for r in rows]
        names = schemas.USER_EVENTS.fieldNames()
        raw = spark.createDataFrame([tuple(t.get(n) for n in names) for t in texts],
                                    ", ".join(f"{n} string" for n in names))
        return raw.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.USER_EVENTS.fields])

    return build


@pytest.fixture
def spend(spark):
    """Build monthly spend rows from (publisher_id, name, format, month, deposits, spend)."""
    from pyspark.sql import functions as F

    from adtally.functions import numeric as num

    def build(rows):
        df = spark.createDataFrame(rows, "publisher_id bigint, publisher_name string, format string, month string, "
                                         "deposits_reported bigint, spend string").withColumn("spend", F.col("spend").cast("decimal(15,2)"))
        cost = num.half_even(num.ratio_floor_one(F.col("spend"), F.col("deposits_reported")), 3)
        return schemas.conform(df.withColumn("current_cpa", cost), schemas.PUBLISHER_SPEND)

    return build


@pytest.fixture
def values(spark):
    """Evaluate a column builder on a list of text values."""
    from pyspark.sql import functions as F

    def run(items, build):
        rows = spark.createDataFrame(list(enumerate(items)), "i int, v string")
        return [r[0] for r in rows.orderBy("i").select(build(F.col("v"))).collect()]

    return run
