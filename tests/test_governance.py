from lakeloom import specs
from lakeloom.functions.masks import register_mask_functions
from lakeloom.operators import governance as G


def _people(spark):
    return spark.createDataFrame([
        ("1", None, None, None), ("2", "5551234", "plain", "no comma"), ("3", "1", "a@b@c", "x, y, ZZ"),
        ("4", "2", "u@d.com", "trailing,"),
    ], "id string, phone_number string, email string, address string")


def test_masks_without_role(spark):
    out = {r.id: r for r in G.masked_view(_people(spark), roles=()).collect()}
    assert out["1"].phone_number == "**********" and out["1"].email is None and out["1"].address is None
    assert out["2"].email == "***plain"                 # no '@': the whole value shows (reference quirk)
    assert out["3"].email == "***@b@c" and out["3"].address == " ZZ"
    assert out["2"].address == "no comma" and out["4"].address == ""
    assert out["4"].email == "***@d.com"


def test_masks_with_role_and_strict(spark):
    df = _people(spark)
    assert sorted(map(tuple, G.masked_view(df, roles=("CRM",)).collect())) == sorted(map(tuple, df.collect()))
    from lakeloom.functions.masks import mask_email, role_column
    strict = df.select(mask_email("email", role_column([]), strict=True).alias("e")).collect()
    assert {r.e for r in strict} == {None, "***", "***@b@c", "***@d.com"}


def test_sql_mask_functions(spark):
    register_mask_functions(spark, roles=())
    _people(spark).createOrReplaceTempView("people")
    r = spark.sql("SELECT masking_phone(phone_number) p, masking_email(email) e, masking_address(address) a "
                  "FROM people WHERE id = '4'").collect()[0]
    assert (r.p, r.e, r.a) == ("**********", "***@d.com", "")


def test_tag_discovery(spark):
    cat = G.tag_catalog(spark, [specs.CUSTOMERS, specs.PRODUCTS,
                                specs.TableSpec("x", "other", (), tags={"sensitivity": "internal"})])
    got = [(r.schema_name, r.table_name) for r in G.tagged_tables(cat).collect()]
    assert got == [("harmonized", "t_customers")]      # key missing / other value not matched


def test_masks_follow_column_tags(spark):
    from dataclasses import replace

    import pytest

    from lakeloom import specs
    from lakeloom.operators import governance as G
    from lakeloom.plans.catalog import create_table
    spec = replace(specs.CUSTOMERS, schema="lakeloom_tag_test")
    cols = [c.name for c in spec.columns]
    df = spark.createDataFrame([("1", "Ann", "Lee", "a@x.com", "123", "1 Road, Rome")],
                               "customer_id string, first_name string, last_name string, email string, phone_number string, address string")
    try:
        create_table(spark, spec)
        tags = G.catalog_column_tags(spark, spec.schema)
        assert sorted(map(tuple, tags.collect())) == sorted(map(tuple, G.column_tags(spark, [spec]).collect()))
        assert {r.column_name for r in tags.collect()} == {"email", "phone_number", "address"} <= set(cols)
        see = lambda roles=(): G.masked_by_tags(df, G.catalog_column_tags(spark, spec.schema), spec.qualified, roles).first()
        assert tuple(see()) == ("1", "Ann", "Lee", "***@x.com", "**********", " Rome")
        assert tuple(see(("CRM",))) == tuple(df.first())
        G.set_column_tag(spark, spec.qualified, "address", "pii", None)
        G.set_column_tag(spark, spec.qualified, "last_name", "pii", "phone")
        assert tuple(see()) == ("1", "Ann", "**********", "***@x.com", "**********", "1 Road, Rome")
        G.set_column_tag(spark, spec.qualified, "first_name", "pii", "o'dd")
        with pytest.raises(ValueError, match="no mask"):
            see()
    finally:
        spark.sql("DROP SCHEMA IF EXISTS lakeloom_tag_test CASCADE")
