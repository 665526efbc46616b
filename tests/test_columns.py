from shelflens.operators import columns as C


def test_map_last_wins_and_copies(spark):
    df = spark.createDataFrame([("s", "a", "n1", "n2")], "`seller-sku` string, asin1 string, `item-name` string, `product-name` string")
    out = C.map_vendor_columns(df).first().asDict()
    assert out["SKU"] == "s" and out["ASIN"] == "a" and out["Title"] == "n2"
    assert out["seller-sku"] == "s"       # loader copies


def test_case_collision_quantity(spark):
    df = spark.createDataFrame([("A", 3, 9)], "SKU string, Quantity long, quantity long")
    out = C.normalize_quantity(df)
    assert out.columns == ["SKU", "quantity"] and out.first()["quantity"] == 3


def test_resolve_title_variants(spark):
    df = spark.createDataFrame([("A", "desc")], "SKU string, `product-description` string")
    assert C.resolve_title(df).first()["Title"] == "desc"
    df2 = spark.createDataFrame([("A",)], "SKU string")
    assert C.resolve_title(df2).first()["Title"] == "Unknown Title"


def test_ensure_columns(spark):
    df = spark.createDataFrame([("A", "B1")], "sku string, Asin string")
    out = C.ensure_columns(df).first().asDict()
    assert out == {"SKU": "A", "ASIN": "B1", "Price": 0.0, "quantity": 0.0}


def test_has_image_sources(spark):
    df = spark.createDataFrame([("A", "url"), ("B", None)], "SKU string, `main-image-url` string")
    assert [r["Has_Image"] for r in C.resolve_has_image(df).orderBy("SKU").collect()] == [True, False]
    df2 = spark.createDataFrame([("A",)], "SKU string")
    assert C.resolve_has_image(df2).first()["Has_Image"] is False


def test_isbn_first_present(spark):
    df = spark.createDataFrame([("A", "p", "e")], "SKU string, `product-id` string, external_product_id string")
    assert C.resolve_isbn(df).first()["ISBN"] == "e"
    assert C.resolve_isbn(spark.createDataFrame([("A",)], "SKU string")).first()["ISBN"] == ""
