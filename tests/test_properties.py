"""Property tests: change rows (both strategies) against a plain Python model."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators.joins import change_rows, delta_key_bounds

keys = st.one_of(st.none(), st.integers(0, 5))
delta_rows = st.lists(st.tuples(st.integers(-1, 12), keys), max_size=12)
snap_rows = st.lists(st.tuples(keys, st.integers(0, 3)), max_size=15)


def model(delta, snap, low, high):
    out = []
    for mark, key in delta:
        if not ((low is None or mark > low) and (high is None or mark <= high)):
            continue
        hits = [s for s in snap if s[0] is not None and s[0] == key]
        if hits:
            out += [(4, key, pos, mark) for _, pos in hits]
        else:
            out.append((2, key, None, mark))
    return sorted(out, key=repr)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(delta=delta_rows, snap=snap_rows, low=st.one_of(st.none(), st.integers(0, 6)),
       high=st.one_of(st.none(), st.integers(3, 12)))
def test_change_rows_match_model(spark, delta, snap, low, high):
    from tidemark.session import scratch_dir
    d = spark.createDataFrame(delta, "mark int, key int")
    s = spark.createDataFrame(snap, "key int, pos int")
    want = model(delta, snap, low, high)
    _, kmin, kmax = delta_key_bounds(d, delta_key="key", mark="mark", low=low, high=high)
    for strategy, salt in (("split", None), ("split", 3), ("outer", None)):
        for bounds in (None, (kmin, kmax)):
            got = change_rows(d, s, delta_key="key", snap_key="key", mark="mark", low=low, high=high,
                              keep_mark=True, strategy=strategy, snap_bounds=bounds, salt=salt)
            assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    got = change_rows(d, s, delta_key="key", snap_key="key", mark="mark", low=low, high=high, keep_mark=True,
                      snap_bounds=(kmin, kmax), salt=3, stage=scratch_dir(spark, "stage"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


small = st.one_of(st.none(), st.integers(0, 3))


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(small, small, small), max_size=10))
def test_stepwise_tuple_max_equals_struct_max(spark, rows):
    from tidemark.operators.aggregates import max_tuple, max_tuple_values
    df = spark.createDataFrame(rows, "WM1 int, WM2 int, WM3 int")
    got = max_tuple_values(df)
    if not rows:
        assert got is None
    else:
        assert got == tuple(max_tuple(df).first())


import json  # noqa: E402

from tidemark.sources.listings import flatten_pages  # noqa: E402

item = st.fixed_dictionaries({"id": st.integers(0, 9)})
value = st.one_of(st.integers(0, 9), st.lists(item, max_size=3))
page = st.one_of(st.dictionaries(st.sampled_from(["value", "data", "n", "x"]), value, max_size=3),
                 st.lists(item, max_size=3))


def listing_model(pages):
    first = pages[0] if pages else None
    name = None
    if isinstance(first, dict):
        if isinstance(first.get("value"), list):
            name = "value"
        else:
            name = next((k for k, v in first.items() if isinstance(v, list)), None)
    out = []
    for p in pages:
        if isinstance(p, dict) and name and isinstance(p.get(name), list):
            out += p[name]
        elif isinstance(p, list):
            out += p
        elif isinstance(p, dict):
            out.append(p)
    return out


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pages=st.lists(page, min_size=1, max_size=4))
def test_flatten_pages_matches_model(spark, pages):
    df = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(pages)], "page_no long, body string")
    got = [json.loads(r.item) for r in flatten_pages(df).orderBy("page_no", "item_pos").collect()]
    assert got == listing_model(pages)


from tidemark.operators.joins import copy_plan  # noqa: E402

names = st.sampled_from(["a", "b", "c", "d"])


def copy_model(reports, target):
    first_target = {}
    for pos, tid, name in sorted(target):
        first_target.setdefault(name, tid)
    made, out = set(), {}
    for root_pos, report_pos, name in sorted(reports):
        if name in first_target:
            out[(root_pos, report_pos)] = ("update", first_target[name])
        elif name in made:
            out[(root_pos, report_pos)] = ("update", None)
        else:
            made.add(name)
            out[(root_pos, report_pos)] = ("clone", None)
    return out


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(reports=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 50), names), max_size=8,
                        unique_by=lambda r: (r[0], r[1])),
       target=st.lists(st.tuples(st.integers(0, 20), names), max_size=4, unique_by=lambda t: t[0]))
def test_copy_plan_matches_sequential_model(spark, reports, target):
    target = [(pos, f"t{pos}", name) for pos, name in target]
    r = spark.createDataFrame(reports, "root_pos int, report_pos long, displayName string")
    t = spark.createDataFrame(target, "pos long, id string, name string")
    got = {(x.root_pos, x.report_pos): (x.action, x.target_report_id)
           for x in copy_plan(r, t, order_cols=("root_pos", "report_pos")).collect()}
    assert got == copy_model(reports, target)


from tidemark.operators.joins import resolve_unique  # noqa: E402

GUID = "12345678-1234-1234-1234-123456789abc"
values = st.one_of(st.none(), st.sampled_from(["a", "b", "c", GUID]))


def lookup_model(inputs, dim):
    out = {}
    for pos, v in inputs:
        if v == GUID:
            out[pos] = (True, None, v, None)
            continue
        ids = sorted(i for i, n in dim if n is not None and n == v)
        n = len(ids)
        out[pos] = (False, n, ids[0] if n == 1 else None, "no match" if n == 0 else ("ambiguous" if n > 1 else None))
    return out


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(inputs=st.lists(values, max_size=6), dim=st.lists(st.sampled_from(["a", "b", None]), max_size=6))
def test_resolve_unique_matches_model(spark, inputs, dim):
    inputs = list(enumerate(inputs))
    dim = [(f"id{i}", n) for i, n in enumerate(dim)]
    got = {r.pos: (r.is_id, r.match_count, r.resolved_id, r.error) for r in resolve_unique(
        spark.createDataFrame(inputs, "pos int, value string"),
        spark.createDataFrame(dim, "id string, displayName string")).collect()}
    assert got == lookup_model(inputs, dim)
