"""Deletes through several levels against a plain walk over the references."""

import random

import pytest
from cartwright.operators import deletion
from cartwright.operators.constraints import DeletionRefused
from cartwright.operators.deletion import Reference
from tables import clean_tables, frame

KEYS = {"a": "id", "b": "id", "c": "id", "d": "id"}
# b lies below a and below itself, c below b and a, d below c and b; a refers to c, which closes a circle.
REFERENCES = [
    Reference("b", "a_id", "a", "id", "cascade"), Reference("b", "b_id", "b", "id", "cascade"),
    Reference("c", "b_id", "b", "id", "cascade"), Reference("c", "a_id", "a", "id", "set_null"),
    Reference("a", "c_id", "c", "id", "cascade"), Reference("d", "c_id", "c", "id", "cascade"),
    Reference("d", "b_id", "b", "id", "restrict"), Reference("d", "a_id", "a", "id", "no_action"),
    Reference("b", "c_id", "c", "id", "set_null"),
]
COLUMNS = {"a": ["id", "c_id"], "b": ["id", "a_id", "b_id", "c_id"], "c": ["id", "b_id", "a_id"], "d": ["id", "c_id", "b_id", "a_id"]}


def plain(rows, chosen, references):
    """Per table: rows deleted by choice, by cascade, cleared, blocking, remaining; and the rows that remain."""
    gone = {t: set(chosen.get(t, ())) for t in rows}
    lost = {t: [r["id"] in gone[t] for r in rows[t]] for t in rows}
    refers = lambda r, ref: r[ref.column] is not None and r[ref.column] in gone[ref.parent]
    while True:
        before = repr(lost)
        for ref in references:
            for i, r in enumerate(rows[ref.child]):
                if ref.action == "cascade" and refers(r, ref):
                    lost[ref.child][i] = True
                    if r["id"] is not None:
                        gone[ref.child].add(r["id"])
        if repr(lost) == before:
            break
    counts, left = {}, {}
    for t in rows:
        own = [r for r in references if r.child == t]
        n = [0] * 5
        left[t] = []
        for r, out in zip(rows[t], lost[t]):
            picked = r["id"] in chosen.get(t, ())
            hit = {a: [x for x in own if x.action == a and refers(r, x)] for a in deletion.ACTIONS}
            n[0] += picked
            n[1] += bool(hit["cascade"]) and not picked
            n[2] += bool(hit["set_null"]) and not out
            n[3] += (bool(hit["restrict"]) and not picked) or (bool(hit["no_action"]) and not out)
            n[4] += not out
            if not out:
                left[t].append(tuple(None if any(x.column == c for x in hit["set_null"]) else r[c] for c in COLUMNS[t]))
        counts[t] = tuple(map(int, n))
    return counts, left


def tables_of(spark, rows):
    return {
        t: spark.createDataFrame([tuple(r[c] for c in COLUMNS[t]) for r in rs], ", ".join(f"{c} long" for c in COLUMNS[t]))
        for t, rs in rows.items()
    }


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("seed", range(2))
def test_equals_a_plain_walk(spark, seed):
    rng = random.Random(seed)
    pick = lambda: rng.choice([None, None, *range(25)])
    rows = {t: [{c: (i if c == "id" else pick()) for c in COLUMNS[t]} for i in range(25)] for t in COLUMNS}
    rows["c"].append({"id": None, "b_id": 3, "a_id": 2})
    chosen = {"a": {rng.randrange(25)}, "b": {3, rng.randrange(25)}}
    tables = tables_of(spark, rows)
    picked = {t: tables[t].filter(tables[t].id.isin(*ids)) for t, ids in chosen.items()}
    closure = deletion.delete_closure(tables, picked, references=REFERENCES, keys=KEYS)
    counts, left = plain(rows, chosen, REFERENCES)
    assert {r[0]: tuple(r)[1:] for r in closure.summary().collect()} == counts
    assert {t: ordered(closure._remaining(t).collect()) for t in rows} == {t: ordered(r) for t, r in left.items()}
    assert {t: b.count() for t, b in closure.blocking().items()} == {"d": counts["d"][3]}


def test_long_chains_and_circles(spark, monkeypatch):
    monkeypatch.setattr(deletion, "_MERGE_PARTS", 3)
    rows = {"b": [{"id": i, "a_id": None, "b_id": i - 1 if i else 11, "c_id": None} for i in range(12)]}
    rows["b"].append({"id": 50, "a_id": None, "b_id": 50, "c_id": None})
    tables = tables_of(spark, rows)
    own = [r for r in REFERENCES if r.child == r.parent]
    chosen = {"b": tables["b"].filter("id = 4")}
    closure = deletion.delete_closure(tables, chosen, references=own, keys=KEYS)
    assert [tuple(r) for r in closure.summary().collect()] == [("b", 1, 12 - 1, 0, 0, 1)]
    assert [r.id for r in closure.remaining()["b"].collect()] == [50]


def test_the_retail_tables(spark):
    t = clean_tables(spark)
    with pytest.raises(DeletionRefused, match="orders"):
        deletion.delete_closure(t, {"customers": t["customers"].filter("customer_id = 1")}).remaining()
    left = deletion.delete_closure(t, {"orders": t["orders"].filter("order_id = 1")}).remaining()
    assert [r.order_item_id for r in left["order_items"].collect()] == [2]
    assert [r.payment_id for r in left["payments"].collect()] == [2]
    assert [(r.review_id, r.order_id) for r in left["reviews"].collect()] == [(1, None)]
    assert all(left[name].columns == t[name].columns for name in t)
    # A customer and the orders in one deletion: the chosen orders forbid nothing.
    both = {"customers": t["customers"].filter("customer_id = 1"), "orders": t["orders"].filter("order_id = 1")}
    left = deletion.delete_closure(t, both).remaining()
    assert [r.customer_id for r in left["customers"].collect()] == [2] and left["reviews"].isEmpty()


def test_category_trees_are_cleared(spark):
    t = clean_tables(spark)
    t["categories"] = frame(spark, "categories", *[dict(category_id=i, parent_category_id=p) for i, p in ((1, None), (2, 1), (3, 2))])
    left = deletion.delete_closure(t, {"categories": t["categories"].filter("category_id = 2")}).remaining()
    assert sorted((r.category_id, r.parent_category_id) for r in left["categories"].collect()) == [(1, None), (3, None)]
    with pytest.raises(DeletionRefused, match="products"):
        deletion.delete_closure(t, {"categories": t["categories"].filter("category_id = 1")}).remaining()


def test_nothing_chosen_and_wrong_keys(spark):
    t = clean_tables(spark)
    none = deletion.delete_closure(t, {"customers": t["customers"].limit(0)})
    assert {r.table_name: r.remaining_rows for r in none.summary().collect()} == {n: df.count() for n, df in t.items()}
    assert none.remaining()["orders"].count() == 2
    with pytest.raises(ValueError, match="not that table's key"):
        deletion.delete_closure(t, {}, references=[Reference("orders", "customer_id", "customers", "email", "cascade")])
    with pytest.raises(ValueError):
        Reference("orders", "customer_id", "customers", "customer_id", "drop")


def test_a_parent_with_most_children(spark):
    # Every third row, and row 7 itself, lies below parent 7.
    rows = spark.range(30_000).selectExpr("id", "IF(id % 3 = 0, 7, id) AS c_id", "CAST(NULL AS LONG) AS b_id", "CAST(NULL AS LONG) AS a_id")
    parents = spark.range(100).selectExpr("id", "CAST(NULL AS LONG) AS b_id", "CAST(NULL AS LONG) AS a_id")
    references = [r for r in REFERENCES if r.child == "d" and r.parent == "c"]
    closure = deletion.delete_closure({"c": parents, "d": rows}, {"c": parents.filter("id = 7")}, references=references, keys=KEYS)
    found = {r.table_name: tuple(r)[1:] for r in closure.summary().collect()}
    assert found == {"c": (1, 0, 0, 0, 99), "d": (0, 10_001, 0, 0, 19_999)}
