import pytest

from starloom.plans.star import SOURCE_COLUMNS
from starloom.sources import (
    JdbcConnection,
    KeyRange,
    key_predicates,
    key_range,
    object_store_conf,
    read_jdbc_table,
    register_views,
    shared_folder,
)
from tests.rental_data import SCHEMAS

SOURCE = JdbcConnection("jdbc:any://host/db", "any.Driver", "me", "secret")


class FakeSession:
    """Records one JDBC read and answers it with a row."""

    def __init__(self, row=None):
        self.row, self.used = row, {}

    @property
    def read(self):
        return self

    def format(self, name):
        self.used["format"] = name
        return self

    def options(self, **options):
        self.used["options"] = options
        return self

    def load(self):
        return self

    def first(self):
        return self.row

    def collect(self):
        return self.row

    def jdbc(self, url, table, predicates, properties):
        self.used["jdbc"] = (url, table, predicates, properties)
        return self


def test_whole_table_read():
    session = FakeSession()
    with pytest.raises(ValueError, match="single_task"):
        read_jdbc_table(session, SOURCE, "customer")
    read_jdbc_table(session, SOURCE, "customer", single_task=True)
    assert session.used == {
        "format": "jdbc",
        "options": {
            "url": "jdbc:any://host/db",
            "driver": "any.Driver",
            "dbtable": "customer",
            "user": "me",
            "password": "secret",
            "fetchsize": "10000",
        },
    }


def test_partitioned_read():
    session = FakeSession()
    read_jdbc_table(session, SOURCE, "payment", KeyRange("payment_id", 1, 900, 4))
    options = session.used["options"]
    assert [options[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")] == [
        "payment_id",
        "1",
        "900",
        "4",
    ]


def test_key_range_sizes_the_read():
    session = FakeSession((5, 9_000_000, 2_500_001))
    assert key_range(session, SOURCE, "payment", "payment_id", 64) == KeyRange(
        "payment_id", 5, 9_000_000, 3
    )
    assert "MIN(payment_id)" in session.used["options"]["query"]
    assert "dbtable" not in session.used["options"]
    huge = FakeSession((0, 1, 10**12))
    assert key_range(huge, SOURCE, "payment", "payment_id", max_tasks=64).partitions == 64


def test_key_range_of_an_empty_table():
    assert key_range(FakeSession((None, None, 0)), SOURCE, "payment", "payment_id", 64) is None


def test_predicates_cut_at_quantiles_and_leave_no_row_out(spark):
    session = FakeSession([(30,), (10,), (20,), (20,), (1_000_000,)])
    parts = key_predicates(session, SOURCE, "payment", "k", 5)
    assert "NTILE(5) OVER (ORDER BY k)" in session.used["options"]["query"]
    rows = spark.createDataFrame([(k,) for k in (None, -5, 10, 11, 20, 21, 30, 31, 2_000_000)], "k int")
    assert len(parts) == 4 and sum(rows.where(p).count() for p in parts) == 9
    assert key_predicates(FakeSession([]), SOURCE, "payment", "k", 5) == ["1 = 1"]
    read_jdbc_table(session, SOURCE, "payment", parts)
    url, table, predicates, properties = session.used["jdbc"]
    assert (url, table, predicates) == (SOURCE.url, "payment", parts) and properties["fetchsize"] == "10000"


def test_optional_credentials_and_hidden_password():
    assert JdbcConnection("u", "d").options() == {"url": "u", "driver": "d"}
    assert "secret" not in repr(SOURCE)


def test_jdbc_read_reaches_spark(spark):
    with pytest.raises(Exception, match="any.Driver"):
        read_jdbc_table(spark, SOURCE, "customer", single_task=True)


def test_object_store_conf():
    conf = object_store_conf("key", "secret", "https://store.example")
    assert conf == {
        "spark.hadoop.fs.s3a.access.key": "key",
        "spark.hadoop.fs.s3a.secret.key": "secret",
        "spark.hadoop.fs.s3a.endpoint": "https://store.example",
    }


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


class Conf(dict):
    get = dict.get


class Session:
    def __init__(self, **conf):
        self.conf = Conf(conf)


def test_shared_folder_is_required_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session(**{"spark.master": "yarn"}))
    local = Session(**{"spark.master": "local[2]", "spark.sql.warehouse.dir": "file:/w/"})
    assert shared_folder(local) == "file:/w/starloom-work"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session(**{"spark.master": "local-cluster[2,1,1024]"}))
    assert shared_folder(Session(**{"spark.checkpoint.dir": "hdfs:///work/"})) == "hdfs:///work"


def test_views_serve_sql_text(spark, sources):
    register_views(sources, prefix="v_")
    found = spark.sql(
        "SELECT c.city, co.country FROM v_city c JOIN v_country co ON c.country_id = co.country_id"
    )
    assert sorted(map(tuple, found.collect())) == [("Lima", "Peru"), ("Oslo", "Norway")]


def test_source_columns_match_the_fixtures():
    assert {t: sorted(c) for t, c in SOURCE_COLUMNS.items()} == {
        t: sorted(part.split()[0] for part in ddl.replace("(12,2)", "").replace("(4,2)", "").split(", "))
        for t, ddl in SCHEMAS.items()
    }
