"""Brute-force check: the aggregate-based list rules (page stop F4 -> first-seen F1 -> take-while F3)
select exactly what the upstream page loop selects, on random small lists."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from murmur.operators import candidates as cd

CUTOFF = datetime(2024, 1, 10)
PAGE = 3


def page_loop(cards, max_pages):
    """The sequential loop: per page, skip seen ids; stop at the first new dated card older than the
    cutoff; stop after a page that adds no new id; at most `max_pages` pages."""
    pages = {}
    for pos, (cid, ts) in enumerate(cards, start=1):
        pages.setdefault((pos - 1) // PAGE + 1, []).append((cid, ts, pos))
    seen, out = set(), []
    for page in sorted(pages):
        if page > max_pages:
            break
        new, stop = 0, False
        for cid, ts, pos in pages[page]:
            if cid in seen:
                continue
            seen.add(cid)
            new += 1
            if ts is not None and ts < CUTOFF:
                stop = True
                break
            out.append((cid, pos))
        if stop or new == 0:
            break
    return sorted(out)


cards_st = st.lists(
    st.tuples(st.sampled_from("abcdefgh"),
              st.one_of(st.none(), st.integers(0, 20).map(lambda d: datetime(2024, 1, 1) + timedelta(days=d)))),
    min_size=1, max_size=14)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cards=cards_st, max_pages=st.integers(1, 5))
def test_list_rules_equal_page_loop(spark, cards, max_pages):
    rows = [("kw", "src", cid, ts, pos, (pos - 1) // PAGE + 1) for pos, (cid, ts) in enumerate(cards, start=1)]
    df = spark.createDataFrame(rows, "keyword string, source string, content_id string, "
                                     "published_ts timestamp_ntz, pos int, page int")
    pages = cd.stop_on_repeat_page(df, max_pages=max_pages)
    seen = cd.first_seen(pages, carry=("published_ts",))
    kept = cd.take_while_newer(seen, CUTOFF)
    got = sorted((r.content_id, r.pos) for r in kept.collect())
    assert got == page_loop(cards, max_pages)


def greedy(events, ttl):
    """Sequential definition: in (ts, id) order, accept when forced or ts >= last accepted + ttl."""
    last, out = {}, []
    for ts, eid, key, forced in sorted(events, key=lambda e: (e[0], e[1])):
        if forced or key not in last or ts >= last[key] + ttl:
            last[key] = ts
            out.append(eid)
    return sorted(out)


events_st = st.lists(
    st.tuples(st.integers(0, 40), st.sampled_from([1, 2]), st.sampled_from([False, False, True])),
    min_size=1, max_size=16)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(evs=events_st)
def test_ttl_rounds_equal_greedy(spark, evs):
    t0 = datetime(2024, 1, 1)
    events = [(t0 + timedelta(days=d), i, k, f) for i, (d, k, f) in enumerate(evs)]
    df = spark.createDataFrame(events, "ts timestamp_ntz, id long, k long, f boolean")
    got = sorted(r.id for r in cd.ttl_dedupe(df, "k", "ts", 7, "id", "f").collect())
    assert got == greedy(events, timedelta(days=7))
