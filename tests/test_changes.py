"""Corrected totals: changes in any order, with clerk moves, deletes, redelivery and damaged messages."""

import json
import random

from pyspark.sql import functions as F

from capstream.operators import changes as C


def message(op, lsn, before=None, after=None):
    def image(r):
        return None if r is None else {"id": r[0], "purchase": r[1], "clerk": r[2], "name": "n"}
    return json.dumps({"payload": {"op": op, "before": image(before), "after": image(after), "source": {"lsn": lsn}}})


def feed(spark, texts, parts=3):
    return spark.createDataFrame([(t,) for t in texts], "value string").repartition(parts)


def history(rng, rows=40):
    """(messages, table that they leave)."""
    lsn, out, table = 0, [], {}
    for _ in range(rows * 5):
        i, lsn = rng.randrange(rows), lsn + 1
        new = (i, rng.choice([None, 5, 7, 100]), rng.choice(["a", "b", None]))
        if i not in table:
            out.append(message(rng.choice("cr"), lsn, None, new))
            table[i] = new
        elif rng.random() < 0.3:
            out.append(message("d", lsn, table.pop(i), None))
        else:
            out.append(message("u", lsn, table[i], new))
            table[i] = new
    return out, table


def expected(table):
    out = {}
    for _, purchase, clerk in table.values():
        n, s = out.get(clerk, (0, None))
        out[clerk] = (n, s) if purchase is None else (n + 1, (s or 0) + purchase)
    return out


def totals(df):
    return {r.p_clerk: (r.p_purchase_count, r.p_purchase_sum) for r in df.collect()}


def test_any_order_gives_the_tables_totals(spark):
    rng = random.Random(4)
    texts, table = history(rng)
    rng.shuffle(texts)
    changes = C.parse_changes(feed(spark, texts))
    assert totals(C.corrected_totals(C.signed_rows(changes), "p")) == expected(table)
    assert {(r.id, r.purchase, r.clerk) for r in C.current_rows(changes).collect()} == set(table.values())
    again = feed(spark, texts + texts[::3])
    assert totals(C.corrected_totals(C.signed_rows(C.once(C.parse_changes(again))), "p")) == expected(table)
    assert {(r.id, r.purchase, r.clerk) for r in C.current_rows(C.parse_changes(again)).collect()} == set(table.values())


def test_damaged_messages_and_missing_images(spark):
    texts = [None, "", "not json", "{}", '{"payload": null}', message("u", 2, None, (1, 5, "a")), message("d", 3, None, None), message("c", None, None, (2, 6, "a")),
             '{"payload": {"op": "c", "after": {"id": 3, "purchase": "text", "clerk": "a"}, "source": {"lsn": 9}}}']
    changes = C.parse_changes(feed(spark, texts), keep=("value",))
    assert changes.columns == ["value", "op", "position", "id", "before", "after"] and changes.count() == 4
    assert totals(C.corrected_totals(C.signed_rows(changes), "p")) == {"a": (2, 11)}
    assert C.corrected_totals(C.signed_rows(changes.limit(0)), "p").collect() == []
    assert {(r.id, r.purchase) for r in C.current_rows(changes.where("id is not null")).collect()} == {(1, 5), (2, 6), (3, None)}


def test_emptied_keys_stay_on_request(spark):
    texts = [message("c", 1, None, (1, 5, "a")), message("u", 2, (1, 5, "a"), (1, 5, "b"))]
    signed = C.signed_rows(C.parse_changes(feed(spark, texts)))
    assert totals(C.corrected_totals(signed, "p")) == {"b": (1, 5)}
    assert totals(C.corrected_totals(signed, "p", emptied=True)) == {"a": (0, None), "b": (1, 5)}


def test_last_changes_of_parts_combine(spark):
    texts, table = history(random.Random(9))
    changes = C.parse_changes(feed(spark, texts))
    halves = [C.last_changes(changes.where(F.col("position") % 2 == i)) for i in (0, 1)]
    assert {(r.id, r.purchase, r.clerk) for r in C.current_rows(halves[0].unionByName(halves[1])).collect()} == set(table.values())


def test_one_parse_and_partial_aggregates(spark, sf, capsys):
    from capstream.plans import standins as S
    C.corrected_totals(C.signed_rows(C.parse_changes(S.change_feed(spark, sf, "postgres"))), "p").explain("formatted")
    p = capsys.readouterr().out
    assert p.count("from_json(") == 1 and "partial_sum" in p
