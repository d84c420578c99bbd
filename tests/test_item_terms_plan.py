"""Terms of all items are never a hash table: the table of idf values is."""
from ratewise.operators import content as CT
from ratewise.session import store


def test_terms_of_items_are_not_broadcast(spark):
    rows = [(k, {"colour": f"c{k % 3}", "noun": f"n{k % 5}"}) for k in range(40)] + [(None, {"colour": "c9"})]
    items = store(spark.createDataFrame(rows, "business_id bigint, attributes map<string,string>"), "items")
    terms = CT.item_terms(items)
    plan = terms._jdf.queryExecution().executedPlan().toString().splitlines()
    under = [plan[k + 1] for k, line in enumerate(plan) if "BroadcastExchange" in line]
    assert all("business_id" not in x for x in under), under
    assert not any("Join" in x and "business_id" in x for x in plan)
    got = terms.groupBy("business_id").agg({"weight": "count"}).collect()
    assert sorted(map(tuple, got)) == [(k, 2) for k in range(40)]          # none of the NULL id
    norms = [sum(r.weight ** 2 for r in terms.collect() if r.business_id == k) for k in range(40)]
    assert all(abs(x - 1) < 1e-9 for x in norms)
