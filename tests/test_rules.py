import pytest
from pyspark.sql import functions as F

from sluice.functions.rules import (Rule, collect_rules, normalise_statements, not_null_rules, rules_by_tag,
                                    rules_for, validate_rules)
from sluice.sources.rules import (FIXTURE_RULES, documents_frame,
                                  publish_documents, rule_documents, tagged_rules_frame)

# The demo's rule documents (states list and date range as given there).
DEMO_RULES = {
    "silver_clients": [
        "ALTER TABLE {schema}.silver_clients ALTER COLUMN client_id SET NOT NULL;",
        "ALTER TABLE {schema}.silver_clients ADD CONSTRAINT validAddress  CHECK (address in ('New York', 'California', 'Texas', 'Florida', 'Illinois'));",
    ],
    "silver_products": [
        "ALTER TABLE {schema}.silver_products ALTER COLUMN product_id SET NOT NULL;",
    ],
    "silver_sales": [
        "ALTER TABLE {schema}.silver_sales ALTER COLUMN sales_id SET NOT NULL;",
        "ALTER TABLE {schema}.silver_sales ALTER COLUMN client_id SET NOT NULL;",
        "ALTER TABLE {schema}.silver_sales ALTER COLUMN product_id SET NOT NULL;",
        "ALTER TABLE {schema}.silver_sales ADD CONSTRAINT dateWithinRange  CHECK (date between '2020-01-01' and '2025-01-01');",
        "ALTER TABLE {schema}.silver_sales ADD CONSTRAINT validQuantity  CHECK (quantity > 0);",
    ],
}

# The demo's tagged rules table, in its order (two rows are equal on purpose).
DEMO_TAGGED_RULES = [
    ("client_id_not_null", "client_id IS NOT NULL", "clients"),
    ("address_valid_value", "address in ('New York', 'California', 'Texas', 'Florida', 'Illinois')", "clients"),
    ("product_id_not_null", "product_id IS NOT NULL", "products"),
    ("sales_id_not_null", "sales_id IS NOT NULL", "sales"),
    ("client_id_not_null", "client_id IS NOT NULL", "sales"),
    ("client_id_not_null", "client_id IS NOT NULL", "sales"),
    ("date_valid_range", "date between '2020-01-01' and '2025-01-01'", "sales"),
    ("quantity_valid_value", "quantity > 0", "sales"),
]



def test_documents_explode_and_normalise(spark):
    stmts = documents_frame(spark, rule_documents(DEMO_RULES, "demo"))
    assert stmts.columns == ["tableName", "col"]
    assert stmts.count() == 8
    norm = {(r.table_name, r.name): (r.kind, r.expression) for r in normalise_statements(stmts).collect()}
    assert norm[("silver_sales", "sales_id_not_null")] == ("not_null", "sales_id IS NOT NULL")
    assert norm[("silver_sales", "dateWithinRange")] == ("check", "date between '2020-01-01' and '2025-01-01'")
    assert norm[("silver_clients", "validAddress")][1].startswith("address in ('New York'")
    assert norm[("silver_clients", "validAddress")][1].endswith("'Illinois')")


def test_nested_parentheses_and_unknown(spark):
    df = spark.createDataFrame([("t", "ALTER TABLE s.t ADD CONSTRAINT c  CHECK ((a > 0) and (b in (1, 2)));"),
                                ("t", "DROP TABLE s.t;")], "tableName string, col string")
    rows = normalise_statements(df).collect()
    assert rows[0].expression == "(a > 0) and (b in (1, 2))"
    assert rows[1].kind == "unknown"
    with pytest.raises(ValueError, match="unreadable"):
        collect_rules(normalise_statements(df))


def test_publish_overwrites(spark, tmp_root):
    docs = rule_documents(FIXTURE_RULES)
    publish_documents(spark, docs, f"{tmp_root}/rules")
    assert publish_documents(spark, docs, f"{tmp_root}/rules").count() == 8


def test_validate_rules_raises_before_reading(spark, tiny):
    validate_rules(tiny, [Rule("ok", "quantity > 0")])
    for bad in ("nope > 0", "quantity >", "sum(quantity) > 0"):
        with pytest.raises(ValueError, match="does not bind"):
            validate_rules(tiny, [Rule("bad", bad)])


def test_not_null_rules_from_schema(spark):
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    s = StructType([StructField("a", LongType(), False), StructField("b", StringType(), True)])
    assert [r.expression for r in not_null_rules(s)] == ["a IS NOT NULL"]


def test_rules_by_tag_collapses_and_conflicts(spark):
    tagged = tagged_rules_frame(spark, DEMO_TAGGED_RULES)
    sales = rules_by_tag(tagged, "sales")
    assert sorted(sales) == ["client_id_not_null", "date_valid_range", "quantity_valid_value", "sales_id_not_null"]
    conflicting = tagged_rules_frame(spark, [("r", "a > 0", "t"), ("r", "a > 1", "t")])
    with pytest.raises(ValueError, match="conflicting"):
        rules_by_tag(conflicting, "t")
    assert rules_by_tag(conflicting, "t", on_conflict="last") == {"r": "a > 1"}


def test_rules_for_filters_by_column(spark):
    stmts = normalise_statements(documents_frame(spark, rule_documents(FIXTURE_RULES)))
    assert rules_for(stmts, table="silver_products").count() == 1
    assert rules_for(stmts, table="x' or '1'='1").count() == 0


def test_rule_action_checked():
    with pytest.raises(ValueError):
        Rule("x", "a > 0", "explode")


def test_one_name_with_two_predicates_raises(spark):
    import pytest
    from sluice.functions.rules import collect_rules
    same = spark.createDataFrame([("t", "r", "x > 0"), ("t", "r", "x > 0"), ("u", "r", "x < 10")], "table_name string, name string, expression string")
    assert len(collect_rules(same)) == 2
    clash = spark.createDataFrame([("t", "r", "x > 0"), ("t", "r", "x < 10")], "table_name string, name string, expression string")
    with pytest.raises(ValueError, match="conflicting"):
        collect_rules(clash)


def test_expect_counts_what_it_keeps(spark):
    from pyspark.sql import Observation
    from sluice.operators.expectations import expect
    seen = Observation()
    df = expect(spark.range(10).selectExpr("if(id < 3, null, id) as x"), "positive", "x > 4", seen)
    assert df.count() == 10 and seen.get == {"rows": 10, "failed": 5}


def test_scratch_folder_is_required_off_local(spark):
    import pytest
    from sluice import session

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: type("C", (), {"get": staticmethod(lambda k, d=None: None)})())

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: None)})()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


def test_published_rules_merge_declared_not_null(spark, tmp_root):
    import pytest
    from pyspark.sql import types as T
    from sluice.sources.rules import publish_documents, published_rules
    publish_documents(spark, rule_documents(FIXTURE_RULES), f"{tmp_root}/rules")
    declared = T.StructType([T.StructField("sales_id", T.LongType(), False), T.StructField("date", T.DateType(), False), T.StructField("quantity", T.IntegerType())])
    names = [r.name for r in published_rules(spark, f"{tmp_root}/rules", "silver_sales", declared)]
    assert names == ["client_id_not_null", "dateWithinRange", "date_not_null", "product_id_not_null", "sales_id_not_null", "validQuantity"]
    publish_documents(spark, rule_documents({"silver_sales": ["ALTER TABLE t ADD CONSTRAINT sales_id_not_null  CHECK (sales_id > 0);"]}), f"{tmp_root}/rules")
    with pytest.raises(ValueError, match="conflicting"):
        published_rules(spark, f"{tmp_root}/rules", "silver_sales", declared)
