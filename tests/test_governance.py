import pytest

from veiledlake.operators import governance as g
from veiledlake.policy import PolicyError

COLUMNS = [
    ("desk", "card", 1, "card_uid", "bigserial", 1),
    ("desk", "card", 2, "card_email", "character varying(80)", None),
    ("desk", "card", 3, "ssn_id", "character(9)", None),
    ("desk", "card", 4, "user_cd", "text", None),
    ("desk", "card", 5, "card_fax", "text", None),
    ("desk", "card", 6, "lnm", "text", None),
    ("comm", "ref", 1, "b", "date", 2),
    ("comm", "ref", 2, "a", "numeric(12,2)", 1),
    ("comm", "nokey", 1, "ssn", "text", None),
]
REQUIREMENTS = [
    ("desk", "card", "card_email", "Hash"),
    ("desk", "card", "card_email", "hash"),
    ("desk", "card", "ssn_id", "HASH"),
    ("desk", "card", "user_cd", "Hash"),
    ("desk", "card", "card_fax", "Exclude"),
    ("desk", "card", "lnm", "None Required"),
    ("comm", "nokey", "ssn", "Mask"),
    ("comm", "ref", "a", None),
]


@pytest.fixture
def columns(spark):
    layout = "schema string, table string, ordinal int, column string, source_type string, pk_position int"
    return spark.createDataFrame(COLUMNS, layout)


@pytest.fixture
def requirements(spark):
    return spark.createDataFrame(REQUIREMENTS, "schema string, table string, column string, requirement string")


@pytest.mark.parametrize(
    "source, stated, legacy",
    [
        ("bigint", "bigint", "int"),
        ("bigserial", "bigint", "int"),
        ("integer", "int", "int"),
        ("smallint", "smallint", "int"),
        ("numeric(8)", "int", "string"),
        ("numeric(14,0)", "bigint", "string"),
        ("NUMBER(12, 2)", "decimal(12,2)", "string"),
        ("numeric(30)", "decimal(30)", "string"),
        ("decimal(8,0)", "decimal(8,0)", "string"),
        ("numeric", "string", "string"),
        ("character varying(30)", "string", "string"),
        ("timestamp(6)", "timestamp", "timestamp"),
        ("date", "date", "date"),
        ("interval", "string", "int"),
    ],
)
def test_types(spark, source, stated, legacy):
    df = spark.createDataFrame([(source,)], "source_type string")
    assert g.map_source_types(df).first()["catalog_type"] == stated
    assert g.map_source_types(df, legacy=True).first()["catalog_type"] == legacy


@pytest.mark.parametrize(
    "name, expected",
    [
        ("emailaddr_txt", "email"),
        ("oth_ssn", "ssn"),
        ("ssn_id", "case_id"),
        ("di_fein", "fein"),
        ("mnm16", "person_nm"),
        ("phnnum_txt", "phone_num"),
        ("email_phone", "phone_num"),
        ("id", None),
        ("user_cd", None),
    ],
)
def test_names(spark, name, expected):
    found = g.classify_columns(spark.createDataFrame([(name,)], "column string")).collect()
    assert [r["pii_type"] for r in found] == ([expected] if expected else [])


def test_schemas_get_the_feed_columns(columns):
    catalog = g.catalog_schema(columns, ["desk"])
    assert g.table_ddl(catalog, "comm", "ref") == "`op` string, `b` date, `a` decimal(12,2)"
    assert g.table_ddl(catalog, "desk", "card").startswith("`op` string, `card_uid` bigint,")
    assert g.table_ddl(catalog, "desk", "card").endswith("`dms_commit_ts` timestamp")


def test_policies(columns, requirements, rows):
    rules = g.build_policy(columns, requirements)
    policies = g.load_policies(rules, ["desk_card", "comm_ref", "comm_nokey"])
    card, ref = policies["desk_card"], policies["comm_ref"]
    assert card.keys == ("card_uid",) and card.drops == ("card_fax",)
    assert card.pii == {"card_email": "email", "ssn_id": "case_id"}
    assert card.path("/clean") == "/clean/desk/desk_card"
    assert ref.keys == ("a", "b") and not ref.pii and not ref.drops
    assert "comm_nokey" not in policies
    assert rows(g.policy_with_keys(columns, requirements)) == [("comm", "ref", 2, 0, 0), ("desk", "card", 1, 1, 3)]


def test_gaps(columns, requirements, rows):
    assert rows(g.policy_gaps(columns, requirements)) == [
        ("comm", "nokey", "ssn", "in clear", "ssn"),
        ("desk", "card", "lnm", "in clear", "person_nm"),
        ("desk", "card", "user_cd", "no type", None),
    ]


def test_vocabulary(requirements, rows):
    found = rows(g.requirement_diff(requirements))
    assert found == [("unknown", "HASH"), ("unknown", "Mask"), ("unknown", "hash")]
    none = requirements.filter("requirement is not null and requirement <> 'Exclude'")
    assert ("unused", None) in rows(g.requirement_diff(none))
    assert ("unused", "Exclude") in rows(g.requirement_diff(none))


def test_list_checks(spark, columns, rows):
    tables = spark.createDataFrame([("desk", "card"), ("desk", "empty")], "schema string, table string")
    assert rows(g.empty_table_check(tables, columns)) == [("desk", "empty")]
    assert rows(g.single_schema_check(columns)) == [(2, False)]
    assert rows(g.single_schema_check(columns.filter("schema = 'desk'"))) == [(1, True)]


def test_mismatch_between_hops(columns, requirements, rows):
    rules = g.build_policy(columns, requirements)
    upper = rules.selectExpr(
        "dataset", "rule", "if(column = 'card_uid', 'CARD_UID', column) as column",
        "if(column = 'a', 3, position) as position", "if(column = 'ssn_id', 'ssn', pii_type) as pii_type",
    ).filter("rule <> 'exclude'")
    assert rows(g.policy_mismatch(rules, rules)) == []
    assert rows(g.policy_mismatch(rules, upper), "left_column", "right_column", "difference") == [
        ("a", "a", "position"),
        ("card_fax", None, "left only"),
        ("card_uid", "CARD_UID", "letter case"),
        ("ssn_id", "ssn_id", "pii type"),
    ]


def test_drift(spark, rows):
    old = g.schema_columns(spark.createDataFrame([], "a int, b string"), "s", "t")
    new = g.schema_columns(spark.createDataFrame([], "a long, c string"), "s", "t")
    assert rows(g.schema_drift(old, new)) == [
        ("s", "t", "a", "int", "bigint", "retyped"),
        ("s", "t", "b", "string", None, "removed"),
        ("s", "t", "c", None, "string", "added"),
    ]


def test_unknown_type_is_refused_when_a_policy_is_loaded(spark):
    rules = spark.createDataFrame(
        [("d", "f", "pii", None, "zip", "zip")],
        "dataset string, folder string, rule string, position int, column string, pii_type string",
    )
    with pytest.raises(PolicyError):
        g.load_policies(rules, ["d"])
