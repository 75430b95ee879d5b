import pytest

from starloom.operators.contracts import CONTRACTS
from starloom.operators.quality import (
    CheckFailed,
    check_all,
    check_foreign_keys,
    check_length,
    check_not_empty,
    check_not_null,
    check_unique_key,
    require_clean,
    require_not_empty,
    row_counts,
)
from starloom.plans.star import build_star


@pytest.fixture(scope="module")
def star(sources):
    return build_star(sources, open_only=False)


def violations(report):
    assert report.columns == ["table", "check", "column", "violations"]
    assert report.schema["violations"].dataType.typeName() == "long"
    return {(r["table"], r["column"]): r["violations"] for r in report.collect()}


def broken(report):
    return {k: n for k, n in violations(report).items() if n}


def test_row_counts(star):
    counts = {r["table"]: r["n"] for r in row_counts(star).collect()}
    assert counts["dim_customer"] == 3 and counts["dim_movie"] == 3 and counts["fact_sales"] == 4


def test_not_empty_passes_and_fails(star):
    require_not_empty(star)
    assert not broken(check_not_empty(star))
    with_gap = {**star, "dim_staff": star["dim_staff"].limit(0), "dim_store": star["dim_store"].limit(0)}
    assert broken(check_not_empty(with_gap)) == {("dim_staff", "*"): 1, ("dim_store", "*"): 1}
    with pytest.raises(ValueError, match="dim_staff"):
        require_not_empty(with_gap)


def test_not_null_reports_each_declared_column(star):
    report = check_not_null(star, CONTRACTS)
    found = violations(report)
    assert len(found) == sum(not f.nullable for n in star for f in CONTRACTS[n].fields)
    # the staff member whose active flag is unknown
    assert broken(report) == {("dim_staff", "active"): 1}


def test_not_null_of_an_empty_table_is_zero(star):
    report = check_not_null({"dim_staff": star["dim_staff"].limit(0)}, CONTRACTS)
    assert set(violations(report).values()) == {0}


def test_unique_key_reports_the_film_in_two_categories(star):
    report = check_unique_key(star, CONTRACTS)
    assert len(violations(report)) == 8
    assert broken(report) == {("dim_movie", "movie_key"): 1}


def test_unique_key_reports_a_century_clash(spark, sources):
    rental = sources["rental"].selectExpr(
        "rental_id", "inventory_id", "explode(array(rental_date, rental_date - INTERVAL 100 YEARS)) "
        "AS rental_date", "return_date"
    )
    star = build_star({**sources, "rental": rental})
    report = check_unique_key({"dim_rental_date": star["dim_rental_date"]}, CONTRACTS)
    assert broken(report) == {("dim_rental_date", "date_key"): 3}


def test_foreign_keys_pass_with_null_keys(star):
    report = check_foreign_keys(star, CONTRACTS)
    assert len(violations(report)) == 7
    assert not broken(report)


def test_foreign_keys_count_orphan_rows(star):
    gaps = {
        **star,
        "dim_customer": star["dim_customer"].where("customer_key <> 1"),
        "dim_movie": star["dim_movie"].limit(0),
    }
    assert broken(check_foreign_keys(gaps, CONTRACTS)) == {
        ("fact_sales", "customer_key"): 2,
        ("fact_sales", "movie_key"): 4,
    }


def test_foreign_keys_of_an_empty_fact(star):
    report = check_foreign_keys({**star, "fact_sales": star["fact_sales"].limit(0)}, CONTRACTS)
    assert len(violations(report)) == 7 and not broken(report)


def test_length(star, sources):
    assert not broken(check_length(star, CONTRACTS))
    address = sources["address"].withColumn("district", sources["address"]["phone"])
    address = address.selectExpr(
        *[f"repeat('d', 21) AS {c}" if c == "district" else c for c in address.columns]
    )
    report = check_length(build_star({**sources, "address": address}), CONTRACTS)
    assert broken(report) == {
        ("dim_customer", "district"): 3,
        ("dim_staff", "district"): 2,
        ("dim_store", "district"): 2,
    }


def test_length_counts_characters_not_bytes(sources):
    address = sources["address"].selectExpr(
        *[f"repeat('é', 20) AS {c}" if c == "district" else c for c in sources["address"].columns]
    )
    assert not broken(check_length(build_star({**sources, "address": address}), CONTRACTS))


def test_all_checks_and_the_gate(star):
    report = check_all(star, CONTRACTS)
    assert {r["check"] for r in report.collect()} == {
        "not_empty",
        "not_null",
        "length",
        "unique_key",
        "foreign_key",
    }
    with pytest.raises(CheckFailed, match=r"dim_movie.movie_key: unique_key \(1\)"):
        require_clean(report)
    require_clean(report.where("violations = 0"))
