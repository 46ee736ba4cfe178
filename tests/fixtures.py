"""Hand-made nested events and user snapshots."""

from __future__ import annotations

from tidemark import schema as S

DAY1, DAY2 = 1_777_611_600_000_000, 1_777_698_000_000_000


def value(text=None, integer=None, number=None, floating=None):
    return (text, integer, floating, number)


def event(
    micros,
    name,
    user="a",
    session=1,
    shard="20260501",
    params=(),
    props=(),
    items=None,
    host="example.test",
    user_id=None,
    revenue=None,
    device="desktop",
    geo=("Asia", "Eastern Asia", "Japan", "Tokyo", "Chiyoda"),
):
    """One event row; ``params`` are (key, value) pairs besides the session number."""
    all_params = [] if session is None else [("ga_session_id", value(integer=session))]
    all_params += list(params)
    return (
        shard, shard, micros, name, user, user_id, all_params, list(props), items,
        (device, "SampleBrand", "SampleModel", "macOS", "14", "Chrome", "en-us", ("Chrome", host)),
        geo, ("google", "organic", "sample"), ("google", "organic", "sample", None, None, None),
        ("Yes",), (None, None), "WEB", (revenue,),
    )


def item(item_id, price=None, quantity=None, params=()):
    names = list(S.ITEM_FIELDS)
    row = [None] * len(names)
    row[names.index("item_id")] = item_id
    row[names.index("price")] = price
    row[names.index("quantity")] = quantity
    return (*row, list(params))


def events_frame(spark, rows):
    return spark.createDataFrame(rows, S.ddl(S.EVENTS))


def user(name, user_id, active, first, slots, shard="20260501", audiences=None):
    """One snapshot row; ``slots`` are (key, property name, micros, text)."""
    return (
        shard, name, user_id, (active, first), ("desktop", "SampleBrand", "macOS"),
        ("Japan", "Tokyo", "Chiyoda"), [(k, (n, m, t)) for k, n, m, t in slots], audiences,
    )


def users_frame(spark, rows):
    return spark.createDataFrame(rows, S.ddl(S.USERS))


def text_param(key, text):
    return (key, value(text=text))


def prop(micros):
    return ("customer_type", ("anonymous_sample", None, None, None, micros))


def sample_events():
    """The four events of the sample data set."""
    home = text_param("page_location", "https://example.test/")
    pricing = text_param("page_location", "https://example.test/pricing")
    thanks = text_param("page_location", "https://example.test/checkout/thank-you")
    guide = text_param("page_location", "https://example.test/articles/guide")

    def msec(n):
        return ("engagement_time_msec", value(integer=n))

    bought = item(
        "sample_item_001", 1200.0, 1, [("sample_item_type", value(text="subscription"))]
    )
    one, two = DAY1 + 60_000_000, DAY1 + 300_000_000
    return [
        event(DAY1, "session_start", "anon_user_001", 10001,
              params=[home, text_param("page_title", "Example Home"), msec(1200)],
              props=[prop(DAY1)], items=[]),
        event(one, "page_view", "anon_user_001", 10001,
              params=[pricing, text_param("page_title", "Example Pricing"), msec(4500)],
              props=[prop(one)], items=[]),
        event(two, "purchase", "anon_user_001", 10001,
              params=[thanks, text_param("transaction_id", "sample_tx_001"), msec(2600)],
              props=[prop(two)], items=[bought], revenue=1200.0),
        event(DAY2, "session_start", "anon_user_002", 20001, shard="20260502",
              params=[guide, text_param("page_title", "Example Guide")],
              props=[prop(DAY2)], items=[]),
    ]


def sample_users():
    return [
        user("anon_user_001", "sample_member_001", DAY1 + 300_000_000, DAY1,
             [("customer_type", "customer_type", DAY1, "sample_member")]),
        user("anon_user_002", None, DAY2, DAY2,
             [("customer_type", "customer_type", DAY2, "sample_visitor")]),
    ]


def write_sharded(frame, path, mode="overwrite", drop=()):
    frame.drop(*drop).write.mode(mode).partitionBy("shard").parquet(str(path))
