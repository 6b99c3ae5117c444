"""Queries on made tables beyond the sizes and characters of the driver's smallest ones."""

import datetime

from kinetrace.plans import catalog


def test_subtask_range_join_covers_a_long_episode(spark, tmp_path):
    first = datetime.datetime(2024, 1, 1)
    rows = [(i, first + datetime.timedelta(minutes=i), 1 if i < 1203 else 2, "click", 1.0) for i in range(1210)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    got = {tuple(r) for r in catalog.QUERIES["subtask_range_join"](spark, str(tmp_path)).collect()}
    want = {(u, f, k, f + (1203 if u == 2 else 0)) for u, n in ((1, 1203), (2, 7)) for f in range(n) for k in range(-(-n // 10)) if k * 10 <= f < k * 10 + 15}
    assert got == want and max(k for _, _, k, _ in got) == 120


def test_split_ranges_reaches_the_last_rows(spark, tmp_path):
    lines = spark.range(61_500).selectExpr("id l_orderkey", "1L l_partkey", "1L l_suppkey", "1 l_linenumber", "2.0D l_quantity", "1.0D l_extendedprice", "date'2024-01-01' l_shipdate")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r.episode: (r.n, r.quantity) for r in catalog.QUERIES["split_ranges"](spark, str(tmp_path)).collect()}
    assert got == {e: (700, 1400.0) for e in range(61)} | {61: (500, 1000.0)}


def test_normalize_instruction_unicode_keeps_all_documents(spark, tmp_path):
    texts = {1: "Pick UP, the cup!", 2: "Öffne die TÜR – «schnell»…", 3: "把 红色_方块 放好。", 4: "café No. 5", 5: None, 6: "", 7: "ДАЙ мне: ключ-42?"}
    want = {1: "pick up the cup", 2: "öffne die tür  schnell", 3: "把 红色_方块 放好", 4: "café no 5", 5: None, 6: "", 7: "дай мне ключ42"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert dict(map(tuple, catalog.QUERIES["normalize_instruction_unicode"](spark, str(tmp_path)).collect())) == want


def test_power_retention_has_shares_of_every_series(spark, tmp_path):
    """Views a day or so apart; the last user's are too rare for the filter."""
    first = datetime.datetime(2024, 1, 1)
    hours = {1: [20 * i + i * i % 7 for i in range(40)], 2: [0, 27, 54, 81, 108, 135, 189], None: [24 * i + i * i % 3 for i in range(20)], 3: [60 * i for i in range(12)]}
    rows = [(i, first + datetime.timedelta(hours=h), u, "view", float(i * i % 13)) for u, own in hours.items() for i, h in enumerate(own)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    got = {r.user_id: r for r in catalog.QUERIES["power_retention"](spark, str(tmp_path)).collect()}
    assert set(got) == set(hours)
    assert all(0 < got[u].high_retention < got[u].low_retention < 1.2 and got[u].filter_error is None for u in (1, 2, None))
    assert (got[3].low_retention, got[3].high_retention) == (1.0, None) and "cutoff" in got[3].filter_error
