from starloom.operators.dimensions import (
    dim_customer,
    dim_movie,
    dim_staff,
    dim_store,
    flatten_geography,
)


def geography(s):
    return flatten_geography(s["address"], s["city"], s["country"])


def test_geography_keeps_complete_addresses_only(sources):
    df = geography(sources)
    assert sorted(r["address_id"] for r in df.collect()) == [1, 2]
    assert "city_id" not in df.columns


def test_dim_customer(sources, rows):
    df = dim_customer(sources["customer"], geography(sources))
    assert df.columns == (
        "customer_key customer_id first_name last_name email address address2 district city "
        "country postal_code phone active create_date"
    ).split()
    # no address, no city, no country: dropped; active 1, 0 and NULL: true, false, false
    assert [(r[0], r[1], r[12]) for r in rows(df)] == [(1, 1, True), (2, 2, False), (3, 3, False)]
    assert rows(df)[0][5:12] == ("1 North St", None, "East", "Oslo", "Norway", "0150", "111")


def test_dim_staff_passes_active_through(sources, rows):
    df = dim_staff(sources["staff"], geography(sources))
    assert "create_date" not in df.columns
    assert [(r[0], r[-1]) for r in rows(df)] == [(1, True), (2, None)]


def test_dim_store_needs_a_manager(sources, rows):
    df = dim_store(sources["store"], sources["staff"], geography(sources))
    assert rows(df) == [
        (1, 1, "1 North St", None, "East", "Oslo", "Norway", "0150", "Mike", "Manager"),
        (2, 2, "2 South St", "Flat 2", "West", "Lima", "Peru", None, "Lia", "Remote"),
    ]


def test_dim_movie(sources, rows):
    df = dim_movie(
        sources["film"], sources["language"], sources["film_category"], sources["category"]
    )
    found = [(r[0], r[1], r[2], r[5], r[10], r[11]) for r in rows(df)]
    # two categories give two rows; no category, unknown category or language give none
    assert found == [
        (1, 1, "First", "English", "Action", "[A b, C, null]"),
        (2, 2, "Second", "French", "Action", "[]"),
        (2, 2, "Second", "French", "Comedy", "[]"),
    ]
