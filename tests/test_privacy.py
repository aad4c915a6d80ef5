from tallyhouse.operators import privacy as P

USER = [(1, "john@example.com", "+1-555-123-4567", "John", "active", 0, "")]
USER_SCHEMA = "id long, email string, phone string, name string, status string, ssn int, address string"
SALT = "test-salt"


def row(df):
    return df.collect()[0].asDict()


def test_payment_tokens_replace_card_data(spark):
    rows = [
        (1, "4111-1111-1111-1111", "123 Main St", "John Doe"),
        (2, None, "", None),
        (3, "12", None, "JOHN DOE"),
    ]
    df = spark.createDataFrame(rows, "id long, card_number string, billing_address string, cardholder_name string")
    out = P.tokenize_payments(df, SALT)
    assert set(out.columns) == {"id", "card_token", "card_last_four", "billing_token", "cardholder_token"}
    first, second, third = (r.asDict() for r in out.orderBy("id").collect())
    assert first["card_token"].startswith("crd_") and first["card_last_four"] == "1111"
    assert first["billing_token"].startswith("adr_") and first["cardholder_token"].startswith("nam_")
    assert set(second.values()) == {2, None}
    assert third["card_last_four"] == "****"
    assert third["cardholder_token"] != first["cardholder_token"]
    text = str(out.collect())
    assert not any(secret in text for secret in ("4111", "Main St", "John Doe"))


def test_payment_tokens_without_card_columns(spark):
    df = spark.createDataFrame([(1, 2.0)], "id long, amount double")
    assert row(P.tokenize_payments(df, SALT)) == {"id": 1, "amount": 2.0}


def test_masked_payments_drop_raw_columns(spark):
    rows = [("4111111111111111", "a", "b"), (None, "a", "b")]
    df = spark.createDataFrame(rows, "card_number string, billing_address string, cardholder_name string")
    assert [r.asDict() for r in P.mask_payments(df).collect()] == [
        {"card_display": "****-****-****-1111"}, {"card_display": "****"}
    ]


def test_redaction_spares_empty_values(spark):
    out = row(P.redact(spark.createDataFrame(USER, USER_SCHEMA)))
    assert out == {
        "id": 1, "email": "[REDACTED]", "phone": "[REDACTED]", "name": "[REDACTED]", "status": "active",
        "ssn": "0", "address": "",
    }


def test_redaction_with_own_columns_and_text(spark):
    df = spark.createDataFrame(USER, USER_SCHEMA)
    out = row(P.redact(df, ["status"], "***"))
    assert out["status"] == "***" and out["email"] == "john@example.com"


def test_older_redaction_replaces_everything(spark):
    df = spark.createDataFrame([(1, None, "", "x")], "id long, email string, phone string, card_number string")
    assert row(P.redact_all(df)) == {"id": 1, "email": "[REDACTED]", "phone": "[REDACTED]", "card_number": "x"}


def test_allow_lists(spark):
    df = spark.createDataFrame(USER, USER_SCHEMA)
    assert P.keep_safe(df).columns == ["id", "status"]
    assert P.keep_safe(df, ["name"]).columns == ["name"]


def test_anonymised_users(spark):
    df = spark.createDataFrame(USER, USER_SCHEMA)
    kept = row(P.anonymize_users(df, drop_originals=False))
    assert kept["email_masked"] == "j***@example.com" and kept["phone_masked"] == "***-***-4567"
    assert all(len(kept[c]) == 32 for c in ("email_hash", "phone_hash", "name_hash"))
    assert not {"email", "phone", "name"} & set(P.anonymize_users(df).columns)
    assert P.anonymize_users(df.select("id")).columns == ["id"]


def test_digests(spark):
    out = row(P.hash_columns(spark.createDataFrame([("test",)], "v string"), ["v"]))
    assert len(out["v_md5"]) == 32 and len(out["v_sha1"]) == 40


def test_nested_fields_are_sanitised(spark):
    df = spark.sql("""
        SELECT 1 AS id, named_struct('userEmail', 'x', 'plain', named_struct('API_KEY', 'y', 'n', 2)) AS info,
            'z' AS Password_Hint, CAST(NULL AS STRUCT<phone: STRING, n: INT>) AS nothing""")
    out = P.sanitize(df).collect()[0].asDict(recursive=True)
    assert out == {
        "id": 1, "info": {"userEmail": "[REDACTED]", "plain": {"API_KEY": "[REDACTED]", "n": 2}},
        "Password_Hint": "[REDACTED]", "nothing": None,
    }


def test_features_hold_nothing_else(spark):
    out = P.contact_features(spark.createDataFrame(USER, USER_SCHEMA))
    assert row(out) == {"id": 1, "email_domain": "example.com", "phone_country_code": "1"}


def test_maps_and_arrays_are_redacted_at_depth(spark):
    rows = spark.sql("""SELECT map('password', 'hunter2', 'city', 'Ulm') AS m, array(named_struct('email', 'a@b.c', 'n', 1)) AS a,
        map('k', named_struct('phone', '1', 'ok', 'x')) AS d, map('user_email', 5, 'n', 6) AS i, array(map('token', 'z')) AS am""")
    got = P.sanitize(rows).first()
    assert got.m == {"password": "[REDACTED]", "city": "Ulm"}
    assert [tuple(x) for x in got.a] == [("[REDACTED]", 1)]
    assert tuple(got.d["k"]) == ("[REDACTED]", "x")
    assert got.i == {"user_email": None, "n": 6}
    assert got.am == [{"token": "[REDACTED]"}]
