"""Hand-computed cases of the dimension merges, and their laws."""

import datetime as dt
import random

import pytest
from conftest import rows

from tidemark import schemas
from tidemark.operators import graph, scd
from tidemark.plans import customer_history
from tidemark.sources.dimension_store import DimensionStore

D1, T, T2 = dt.date(2024, 1, 1), dt.date(2024, 6, 1), dt.date(2024, 7, 1)
S = dt.date(2023, 1, 1)
S_NEW = dt.date(2023, 9, 9)


def customer(key, **given):
    base = {
        "customer_id": key, "full_name": f"n{key}", "email": f"e{key}", "phone": f"p{key}",
        "city": f"c{key}", "address": f"a{key}", "status": "active", "sign_up_date": S,
        "age": 30, "subscription_type": "basic",
    }
    return {**base, **given}


def frame(spark, people):
    names = [f.split()[0] for f in schemas.CUSTOMER.split(", ")]
    return spark.createDataFrame([tuple(p[n] for n in names) for p in people], schemas.CUSTOMER)


# 1 unchanged, 2 email, 3 only the age, 4 absent, 5 address value → null,
# 6 address null → value, 7 only the name, 8 new
FIRST = [customer(k) for k in (1, 2, 3, 4, 5)] + [customer(6, address=None), customer(7)]
LATER = [
    customer(1),
    customer(2, email="x2", sign_up_date=S_NEW, age=31, full_name="m2"),
    customer(3, age=31),
    customer(5, address=None),
    customer(6, address="a6"),
    customer(7, full_name="m7"),
    customer(8, sign_up_date=S_NEW),
]
WAYS = [pytest.param({}, id="broadcast"), pytest.param({"max_rows": 0}, id="shuffled")]


@pytest.fixture(scope="module")
def first(spark):
    return frame(spark, FIRST)


@pytest.fixture(scope="module")
def later(spark):
    return frame(spark, LATER)


def versions(table):
    wanted = ["customer_id", "email", "address", "sign_up_date", "age", "valid_from",
              "valid_to", "is_current"]
    return {(r[0], r[5]): tuple(r)[1:5] + tuple(r)[6:] for r in table.select(*wanted).collect()}


@pytest.mark.parametrize("way", WAYS)
def test_type2_relational(first, later, way):
    loaded = scd.type2_load(first, D1)
    got = versions(scd.type2_apply(loaded, later, T, **way))
    assert len(got) == 9
    assert got[(2, S)] == ("e2", "a2", S, 30, T, False)
    assert got[(2, T)] == ("x2", "a2", S, 31, None, True)  # the old sign-up date stays
    assert got[(3, S)] == ("e3", "a3", S, 30, None, True)  # untracked: nothing happens
    assert got[(4, S)][-1] is True
    assert got[(5, S)] == ("e5", "a5", S, 30, None, True)  # address is not tracked here
    assert got[(8, T)] == ("e8", "a8", S_NEW, 30, None, True)


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize(
    "rules, start, new_start",
    [(scd.TYPE2_DOCUMENT, D1, T), (scd.TYPE2_GRAPH, S, S_NEW)],
    ids=["document", "graph"],
)
def test_type2_six_fields(first, later, rules, start, new_start, way):
    loaded = scd.type2_load(first, D1, rules)
    got = versions(scd.type2_apply(loaded, later, T, rules, **way))
    assert len(got) == 11
    assert got[(2, T)] == ("x2", "a2", S_NEW, 31, None, True)  # the new sign-up date
    assert got[(5, start)] == ("e5", "a5", S, 30, T, False)
    assert got[(5, T)] == ("e5", None, S, 30, None, True)
    assert got[(6, T)] == ("e6", "a6", S, 30, None, True)
    assert got[(7, start)][-1] is True
    assert got[(8, new_start)] == ("e8", "a8", S_NEW, 30, None, True)


@pytest.mark.parametrize(
    "rules", [scd.TYPE2_RELATIONAL, scd.TYPE2_DOCUMENT, scd.TYPE2_GRAPH]
)
def test_type2_laws(first, later, rules):
    once = scd.type2_apply(scd.type2_load(first, D1, rules), later, T, rules)
    again = scd.type2_apply(once, later, T2, rules)
    assert rows(once) == rows(again)  # a replayed batch changes nothing
    open_per_key = once.filter("is_current").groupBy("customer_id").count()
    assert {r["count"] for r in open_per_key.collect()} == {1}
    by_key = {}
    for r in once.select("customer_id", "valid_from", "valid_to").collect():
        by_key.setdefault(r[0], []).append((r[1], r[2] or dt.date.max))
    for periods in by_key.values():
        periods.sort()
        assert all(a[1] <= b[0] for a, b in zip(periods, periods[1:]))


def test_change_on_the_day_of_the_version_ends_the_query(first, later):
    loaded = scd.type2_load(first, T, scd.TYPE2_DOCUMENT)
    with pytest.raises(Exception, match="later than the version"):
        scd.type2_apply(loaded, later, T, scd.TYPE2_DOCUMENT).collect()


def test_repeated_key_ends_the_query_or_last_wins(spark, first):
    twice = frame(spark, [customer(2, email="b"), customer(2, email="z")])
    loaded = scd.type2_load(first, D1)
    with pytest.raises(Exception, match="not unique"):
        scd.type2_apply(loaded, twice, T).collect()
    got = versions(scd.type2_apply(loaded, twice, T, order_by="email"))
    assert got[(2, T)][0] == "z"
    with pytest.raises(Exception, match="not unique"):
        scd.type2_apply(loaded, twice, T).count()  # not pruned away


def test_null_key_ends_the_query(spark, first):
    bad = frame(spark, [customer(None)])
    with pytest.raises(Exception, match="is null"):
        scd.type2_apply(scd.type2_load(first, D1), bad, T).collect()


def test_point_in_time(first, later):
    table = scd.type2_apply(scd.type2_load(first, D1), later, T)
    emails = {r[0]: r[1] for r in scd.valid_on(table, dt.date(2024, 5, 31)).select(
        "customer_id", "email").collect()}
    assert emails[2] == "e2" and 8 not in emails
    emails = {r[0]: r[1] for r in scd.valid_on(table, T).select("customer_id", "email").collect()}
    assert emails[2] == "x2" and 8 in emails


@pytest.mark.parametrize("way", WAYS)
def test_type3_relational(first, later, way):
    got = {
        r["customer_id"]: r.asDict()
        for r in scd.type3_merge(scd.type3_load(first), later, T, **way).collect()
    }
    assert len(got) == 8
    two = got[2]
    assert (two["email"], two["previous_email"], two["previous_city"]) == ("x2", "e2", None)
    assert (two["full_name"], two["sign_up_date"], two["age"]) == ("n2", S, 31)
    assert two["last_update_date"] == T
    assert got[3]["age"] == 31 and got[3]["last_update_date"] == T
    assert got[5]["address"] is None and got[5]["previous_email"] is None
    assert got[7]["full_name"] == "n7" and got[7]["last_update_date"] == S
    assert got[8]["last_update_date"] == T and got[1]["last_update_date"] == S


def test_type3_document(spark, first, later):
    rules = scd.TYPE3_DOCUMENT
    one = scd.type3_merge(scd.type3_load(first, rules), later, T, rules)
    got = {r["customer_id"]: r.asDict() for r in one.collect()}
    assert got[2]["previous_email"] == "e2" and got[2]["age"] == 30
    assert got[3]["age"] == 30 and got[3]["last_update_date"] == S
    assert got[5]["previous_address"] == "a5" and got[5]["address"] is None
    assert got[6]["previous_address"] is None and got[6]["address"] == "a6"
    # A later change of another field keeps what was remembered.
    next_day = frame(spark, [customer(2, email="x2", city="z2")])
    two = scd.type3_merge(one, next_day, T2, rules)
    row = two.filter("customer_id = 2").first()
    assert (row["previous_email"], row["previous_city"], row["city"]) == ("e2", "c2", "z2")
    assert row["last_update_date"] == T2


@pytest.mark.parametrize("way", WAYS)
def test_type4_relational(first, later, way):
    current, history = scd.type4_load(first, D1)
    current, history = scd.type4_merge(current, history, later, T, **way)
    now = {r["customer_id"]: r.asDict() for r in current.collect()}
    assert len(now) == 8
    assert (now[2]["email"], now[2]["full_name"], now[2]["sign_up_date"]) == ("x2", "m2", S)
    assert now[3]["age"] == 31 and now[7]["full_name"] == "n7"
    past = [r for r in history.collect() if r["valid_to"] is not None]
    assert sorted(r["customer_id"] for r in past) == [2, 3, 5, 6]
    assert {(r["valid_from"], r["valid_to"]) for r in past} == {(S, T)}
    still_open = [r for r in history.collect() if r["valid_to"] is None]
    assert len(still_open) == 7 and {r["valid_from"] for r in still_open} == {D1}


@pytest.mark.parametrize("way", WAYS)
def test_type4_closing_the_open_history(first, later, way):
    current, history = scd.type4_load(first, D1)
    _, history = scd.type4_merge(current, history, later, T, close_open_history=True, **way)
    still_open = history.filter("valid_to is null")
    assert sorted(r["customer_id"] for r in still_open.collect()) == [1, 4, 7]


def test_type4_graph(first, later):
    rules = scd.TYPE4_GRAPH
    current, history = scd.type4_load(first, D1, rules)
    assert history.count() == 0
    current, history = scd.type4_merge(current, history, later, T, rules)
    now = {r["customer_id"]: r.asDict() for r in current.collect()}
    assert (now[2]["email"], now[2]["full_name"], now[2]["age"]) == ("x2", "n2", 30)
    assert now[3]["age"] == 30
    assert sorted(r["customer_id"] for r in history.collect()) == [2, 5, 6]


def test_reloading_the_first_day_inserts_nothing(first):
    for loaded in (
        scd.type2_load(first, D1),
        scd.type3_load(first),
        scd.type4_load(first, D1)[0],
        scd.type4_load(first, D1)[1],
    ):
        assert rows(scd.insert_if_absent(loaded, loaded)) == rows(loaded)
    a_later_day = scd.type2_load(first, T, scd.TYPE2_DOCUMENT)
    before = scd.type2_load(first, D1, scd.TYPE2_DOCUMENT)
    assert rows(scd.insert_if_absent(before, a_later_day)) == rows(before)


def test_insert_if_absent_takes_the_first_of_a_key(spark, first):
    incoming = frame(spark, [customer(9, email="b"), customer(9, email="a"), customer(1, email="q")])
    for way in ({}, {"max_rows": 0}):
        got = scd.insert_if_absent(first, incoming, order_by="email", **way)
        emails = {r["customer_id"]: r["email"] for r in got.collect()}
        assert emails[9] == "a" and emails[1] == "e1" and got.count() == 8


def test_document_ids(first):
    loaded = scd.type2_load(first, D1, scd.TYPE2_DOCUMENT)
    ids = {r["_id"] for r in scd.with_document_id(loaded, "customer_id", "valid_from").collect()}
    assert "1:2024-01-01" in ids
    ids = {r["_id"] for r in scd.with_document_id(first, "customer_id").collect()}
    assert "1" in ids


def test_graph_layout(first, later):
    table = scd.type2_apply(
        scd.type2_load(first, D1, scd.TYPE2_GRAPH), later, T, scd.TYPE2_GRAPH
    )
    main, nodes = graph.main_nodes(table, "2024-06-01"), graph.version_nodes(table)
    edges = graph.version_edges(table)
    assert main.count() == 8 and nodes.count() == edges.count() == 11
    found = graph.open_versions(main, edges, nodes)
    assert rows(found, "customer_id") == [(k,) for k in range(1, 9)]
    every = graph.follow(main, edges, nodes, "HAS_VERSION")
    assert every.count() == 11


def test_published_versions(spark, first, later, tmp_path):
    path = str(tmp_path / "dim")
    store = DimensionStore(spark, path)
    assert store.newest() == -1
    store.publish_first(first, D1)
    store.publish_first(later, T)  # already there
    assert store.publish(later, T) == 1
    want = scd.type2_apply(scd.type2_load(first, D1), later, T)
    assert rows(store.read()) == rows(want)
    assert store.read_current().count() == 8
    # A merge that broke off leaves no marker, hence nothing to see.
    broken = tmp_path / "dim" / "batch=2" / "kind=delta" / "buckets=1" / "table=open" / "bucket=0"
    broken.mkdir(parents=True)
    assert store.newest() == 1
    assert rows(store.read()) == rows(want)
    assert store.publish(later, T2) == 2
    assert rows(store.read()) == rows(want)


def test_two_days_from_files(spark, first, later, tmp_path):
    for name, table in (("one", first), ("two", later)):
        table.coalesce(1).write.option("header", True).csv(str(tmp_path / name))
    for rules, count in ((scd.TYPE2_GRAPH, 11), (scd.TYPE3_RELATIONAL, 8), (scd.TYPE4_RELATIONAL, 8)):
        store = customer_history.from_files(
            spark, str(tmp_path / f"dim{count}{type(rules).__name__}"), str(tmp_path / "one"),
            [(str(tmp_path / "two"), T)], D1, rules,
        )
        # Empty cells are empty texts, so null and '' do not differ here.
        assert store.read().count() == count
        assert store.read().filter("address = ''").count() == (2 if count == 11 else 1)


def test_closed_versions_are_not_read_by_a_merge(spark, first, later, tmp_path):
    store = DimensionStore(spark, str(tmp_path / "dim"))
    store.publish_first(first, D1)
    store.publish(later, T)
    store.compact()
    text = store.read_current()._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in text and "table" in text.split("PartitionFilters")[1]


def written(store):
    """Rows of all tables that the newest batch wrote."""
    newest = [f for f in store.folders() if f.kind == "delta"][-1]
    return store.spark.read.parquet(newest.path).count()


@pytest.mark.parametrize("rules", [scd.TYPE2_RELATIONAL, scd.TYPE3_RELATIONAL, scd.TYPE4_RELATIONAL])
def test_a_batch_writes_its_changes_and_not_the_dimension(spark, tmp_path, rules):
    store = DimensionStore(spark, str(tmp_path / "dim"), rules, bucket_rows=50)
    people = [customer(k) for k in range(400)]
    store.publish_first(frame(spark, people), D1)
    assert {f.buckets for f in store.folders()} == {8}
    days = [dt.date(2024, 6, n) for n in (1, 2, 3)]
    for n, day in enumerate(days):
        batch = [customer(7, email=f"new{n}", age=40 + n), customer(8), customer(9)]
        store.publish(frame(spark, batch), day)
        assert written(store) <= 3
    got = store.read().filter("customer_id = 7")
    if rules is scd.TYPE2_RELATIONAL:
        assert rows(got, "email", "valid_from", "valid_to") == sorted(
            [("e7", S, days[0]), ("new0", days[0], days[1]), ("new1", days[1], days[2]),
             ("new2", days[2], None)], key=repr)
    elif rules is scd.TYPE3_RELATIONAL:
        assert rows(got, "email", "previous_email", "last_update_date") == [("new2", "new1", days[2])]
    else:
        past = store.read_history().filter("customer_id = 7 AND valid_to IS NOT NULL")
        assert rows(past, "email", "valid_to") == sorted(
            [("e7", days[0]), ("new0", days[1]), ("new1", days[2])], key=repr)
        assert rows(got, "email", "age") == [("new2", 42)]
    assert store.read_current().count() == 400


@pytest.mark.parametrize("rules", [scd.TYPE2_DOCUMENT, scd.TYPE3_DOCUMENT, scd.TYPE4_GRAPH])
def test_stored_rows_equal_merges_of_tables_before_and_after_folding(spark, first, later, tmp_path, rules):
    store = customer_history.published(
        spark, str(tmp_path / "dim"), first, [(later, T), (first, T2)], D1, rules
    )
    if isinstance(rules, scd.Type2Rules):
        want = scd.type2_apply(scd.type2_load(first, D1, rules), later, T, rules)
        want = scd.type2_apply(want, first, T2, rules)
    elif isinstance(rules, scd.Type3Rules):
        want = scd.type3_merge(scd.type3_load(first, rules), later, T, rules)
        want = scd.type3_merge(want, first, T2, rules)
    else:
        pair = scd.type4_load(first, D1, rules)
        for batch, day in ((later, T), (first, T2)):
            pair = scd.type4_merge(*pair, batch, day, rules)
        want = pair[0]
        assert rows(store.read_history()) == rows(pair[1])
    want, history = rows(want), rows(store.read_history())
    assert rows(store.read()) == want
    open_rows = rows(store.read_current())
    keys = rows(store.open_rows_per_key())
    assert keys == sorted([(k, 1) for k in range(1, 9)], key=repr)
    store.compact()
    store.remove_replaced()
    assert [f.kind for f in store._live()] == ["base"]
    assert rows(store.read()) == want and rows(store.read_current()) == open_rows
    assert rows(store.read_history()) == history and rows(store.open_rows_per_key()) == keys
    store.publish(later, dt.date(2025, 1, 1))
    assert store.read_current().count() == 8


def test_changes_are_folded_once_they_take_a_share_of_the_base(spark, first, later, tmp_path):
    store = DimensionStore(spark, str(tmp_path / "dim"), delta_bytes=0, delta_share=1e9)
    store.publish_first(first, D1)
    store.publish(later, T)
    assert [f.kind for f in store._live()] == ["base", "delta"]
    store.delta_share = 0.01
    store.publish(frame(spark, [customer(1, email="z")]), T2)
    assert [f.kind for f in store._live()] == ["base"]
    assert store.read().filter("customer_id = 1").count() == 2 and store.newest() == 2


@pytest.mark.parametrize("size", [1, 300])
@pytest.mark.parametrize("rules", [scd.TYPE2_RELATIONAL, scd.TYPE4_GRAPH])
def test_two_open_rows_of_a_key_end_any_batch_of_its_bucket(spark, tmp_path, size, rules):
    people = frame(spark, [customer(k) for k in (*range(20), 5)])
    rows_ = scd.type2_load(people, S, rules) if isinstance(rules, scd.Type2Rules) else people
    if isinstance(rules, scd.Type2Rules):
        rows_ = rows_.withColumn("valid_from", rows_.sign_up_date)
    store = DimensionStore(spark, str(tmp_path / "dim"), rules)
    store.adopt(rows_)
    batch = frame(spark, [customer(100 + k) for k in range(size)])
    with pytest.raises(ValueError, match="customer_id 5 has several current rows"):
        store.publish(batch, T)
    assert store.newest() == 0


def test_a_large_batch_is_not_broadcast(first, later):
    text = scd.type2_apply(
        scd.type2_load(first, D1), later, T, max_rows=0
    )._jdf.queryExecution().optimizedPlan().toString()
    assert "Join FullOuter" in text


def test_several_days_equal_a_plain_account(spark, tmp_path):
    """Random batches through stored batches against a dictionary of versions."""
    rng = random.Random(5)
    store = DimensionStore(spark, str(tmp_path / "dim"), bucket_rows=5, delta_bytes=0, delta_share=1.2)
    people = {k: customer(k) for k in range(12)}
    store.publish_first(frame(spark, people.values()), D1)
    account = {k: [(p["email"], p["city"], p["age"], S, None)] for k, p in people.items()}
    for day in (dt.date(2024, 2, n) for n in (1, 2, 3)):
        batch = []
        for k in rng.sample(range(16), 9):
            change = customer(
                k, email=rng.choice(["a", "b", None]), city=rng.choice(["x", "y"]),
                age=rng.randrange(90),
            )
            batch.append(change)
            past = account.setdefault(k, [])
            now = (change["email"], change["city"], change["age"], day, None)
            if past and past[-1][:2] == now[:2]:
                continue
            if past:
                past[-1] = (*past[-1][:4], day)
            past.append(now)
        store.publish(frame(spark, batch), day)
    got = store.read().select(
        "customer_id", "email", "city", "age", "valid_from", "valid_to", "is_current"
    )
    want = [(k, *v, v[-1] is None) for k, past in account.items() for v in past]
    assert rows(got) == sorted(want, key=repr)


@pytest.mark.parametrize("limits", [{}, {"max_rows": 0}], ids=["small", "large"])
def test_two_current_rows_of_a_changed_key_end_the_merge(spark, limits):
    people = frame(spark, [customer(1), customer(1, city="x"), customer(2)])
    opened = scd.type2_load(people, S)
    with pytest.raises(Exception, match="several current rows|not unique"):
        changed = frame(spark, [customer(1, city="y")])
        scd.type2_merge(opened, changed, dt.date(2030, 1, 1), **limits).collect()


def test_an_inserted_null_key_ends_the_query(spark, first):
    nobody = frame(spark, [customer(None)])
    with pytest.raises(Exception, match="customer_id is null"):
        scd.insert_if_absent(first, nobody).collect()


@pytest.mark.parametrize("limits", [{}, {"max_rows": 0}], ids=["small", "large"])
def test_two_current_rows_of_another_key_end_the_merge_as_well(spark, limits):
    opened = scd.type2_load(frame(spark, [customer(1), customer(1, city="x"), customer(2)]), S)
    for batch in ([customer(2, city="y")], [customer(3)], [customer(2)]):
        with pytest.raises(Exception, match="not unique"):
            scd.type2_merge(opened, frame(spark, batch), T, **limits).collect()


def test_changes_before_the_first_batch_are_new_versions(spark, tmp_path):
    store = DimensionStore(spark, str(tmp_path / "dimension"))
    assert store.read().count() == 0
    people = frame(spark, [customer(1), customer(2)])
    assert store.publish(people, dt.date(2030, 1, 1)) == 0
    assert rows(store.read_current(), "customer_id") == [(1,), (2,)]
