"""Plans that must hold when the tables do not fit one task."""

import pytest
from pyspark.sql import functions as F

from tidemark import session, workload
from tidemark.functions.places import PLACE
from tidemark.operators import kmeans, wide
from tidemark.plans import trends
from tidemark.sources import tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("query", workload.QUERIES, ids=lambda q: q.__name__)
def test_no_query_pairs_all_rows(spark, root, query):
    text = plan(query(spark, root))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert "BatchEvalPython" not in text


@pytest.fixture
def without_broadcast(spark):
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "64",
    }
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_customer_with_a_third_of_all_orders_is_split(spark, tmp_path, without_broadcast):
    """Orders of one customer dominate; the join splits them and every order counts once."""
    root = str(tmp_path)
    orders = spark.range(0, 300_000, numPartitions=8).selectExpr(
        "IF(id % 3 = 0, 7L, id % 5000) AS o_custkey", "cast(date_add(DATE'1995-01-01', cast(id % 40 AS int)) AS timestamp_ntz) AS o_orderdate"
    )
    orders.write.parquet(f"{root}/orders.parquet")
    spark.range(5000).selectExpr(
        "id AS c_custkey", "cast(id % 25 AS int) AS c_nationkey", "1.0D AS c_acctbal", "'BUILDING' AS c_mktsegment"
    ).write.parquet(f"{root}/customer.parquet")
    spark.range(25).selectExpr("cast(id AS int) AS n_nationkey", "concat('NATION_', id) AS n_name").write.parquet(
        f"{root}/nation.parquet"
    )
    counts = tables.order_counts(spark, root)
    total = {r.country: r.n for r in counts.groupBy("country").agg(F.sum("n").alias("n")).collect()}
    assert sum(total.values()) == 300_000 and total["NATION_7"] > 100_000
    counts.collect()
    assert "skew=true" in plan(counts)


def test_orders_are_read_once_and_narrow(spark, root):
    df = trends.continent_daily(tables.order_panel(spark, root), tables.place_locations(spark, root), PLACE)
    df.collect()
    final = plan(df)
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in final
    assert "ReusedExchange [country" in final


def test_slopes_need_no_window_and_no_second_shuffle(spark, root):
    slopes = plan(trends.daily_slopes(tables.order_panel(spark, root), PLACE))
    panel = plan(tables.order_panel(spark, root))
    assert slopes.count("Exchange hashpartitioning") == panel.count("Exchange hashpartitioning")
    assert slopes.count("Window") == panel.count("Window")


@pytest.mark.parametrize("query", [workload.continent_label, workload.continent_label_sql])
def test_continents_are_one_projection(spark, root, query):
    text = plan(query(spark, root))
    assert "Exchange" not in text and "Join" not in text and "Python" not in text


def test_wide_means_read_only_month_ends(spark, tmp_path):
    from tidemark.functions.places import COUNTRY
    from tidemark.plans.monthly import mean_by_country_wide

    path = str(tmp_path / "wide")
    days = [f"1/{d}/20" for d in range(22, 32)] + [f"2/{d}/20" for d in range(1, 10)]
    cells = ", ".join(f"id AS `{d}`" for d in days)
    spark.sql(f"SELECT 'x' AS `Province/State`, 'A' AS `{COUNTRY}`, 1D AS Lat, 2D AS Long, {cells} FROM range(9)").write.parquet(path)
    text = plan(mean_by_country_wide(spark.read.parquet(path)))
    assert "ReadSchema: struct<Country/Region:string,1/31/20:bigint,2/9/20:bigint>" in text
    data = spark.read.parquet(path)
    assert "Exchange" not in plan(wide.monthly_mean(data, [COUNTRY], days))


def test_rounds_shuffle_groups_not_points(spark):
    """A round joins the state by broadcast and combines points before its only shuffle."""
    points = session.settle(
        kmeans.grid_points(spark.range(1000).selectExpr("id % 3 AS g", "cast(id / 3 AS int) AS rank", "cast(id AS double) AS v"), "g", "v"),
        "points",
    )
    state = session.settle(kmeans.start(points, "g", (1, 5)), "state")
    text = plan(kmeans.update(points, state, "g", 2))
    assert text.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in text
    assert text.index("Exchange hashpartitioning") < text.index("partial_sum")


def test_shared_folder_comes_from_the_session(spark):
    kept = session.settle(spark.range(3), "kept")
    assert all(f"{session.shared_dir(spark)}/kept-" in path for path in kept.inputFiles())


class Unset:
    """A session that names no folder."""

    def __init__(self, master):
        self.conf = self.sparkContext = self
        self.master, self.folder = master, None

    def get(self, key, default):
        return {"spark.master": self.master}.get(key, default)

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_only_a_local_session_may_choose_its_own_folder():
    local = Unset("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local) == local.folder
    with pytest.raises(ValueError, match="share"):
        session.shared_dir(Unset("spark://host:7077"))
