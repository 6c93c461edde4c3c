import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.plans import assembly, cohort, recommend, topics, tree, usage

USERS = "tree_user_id long, user_id long, sponsor_id long, created timestamp_ntz, coded timestamp_ntz, type string, client_type string, client string"
ORDERS = "order_id long, commission_user_id long, tree_user_id long, type string, status string, total decimal(19,4), order_date timestamp_ntz, is_autoship boolean"


def user(i, sponsor=None, day="2020-01-01", kind="Distributor"):
    return (i, i, sponsor, day, day, kind, kind, "north")


def order(frame_rows):
    from decimal import Decimal

    return [(i, c, t, k, s, Decimal(x), d, False) for i, c, t, k, s, x, d in frame_rows]


def test_repeated_deliveries_count_once_and_users_without_orders_stay(frame):
    users = frame(USERS, user(1), user(2), user(3))
    rows = order([
        (1, 1, 1, "Retail", "Active", 10, "2020-01-05"), (1, 1, 1, "Retail", "Active", 10, "2020-01-05"),
        (2, 1, 1, "Wholesale", "Active", 5, "2020-03-01"), (3, 1, 1, "Retail", "Cancelled", 99, "2020-01-02"),
        (4, 2, 2, "Retail", "Active", 7, "2019-12-01"),
    ])
    got = {r["days_to_order_bucket"]: r for r in cohort.lifetime_value(users, frame(ORDERS, *rows)).collect()}
    # user 2 only ordered before sign-up and is gone; user 3 never ordered and stays
    assert set(got) == {None, "1-15"} and got[None]["mp_count"] == 1
    first = got["1-15"]
    assert (first["sales_count"], float(first["sales_total"]), first["wholesale_count"], float(first["total"])) == (1, 10.0, 1, 15.0)


def test_days_to_first_sale_shares(frame):
    users = frame(USERS, *[user(i) for i in range(1, 5)])
    days = {1: "2019-12-31", 2: "2020-01-02", 3: "2020-01-02", 4: "2020-01-06"}
    rows = order([(i, i, i, "Retail", "Active", 1, d) for i, d in days.items()])
    got = [tuple(r) for r in cohort.days_to_first_sale(users, frame(ORDERS, *rows)).orderBy("days_to_first_sale").collect()]
    assert got == [(-1, 1, 0.25, 1, 0.25, None, None), (1, 2, 0.5, 3, 0.75, 2, 2 / 3), (5, 1, 0.25, 4, 1.0, 3, 1.0)]


def test_last_order_of_a_kind_only_if_it_is_the_last_of_all(frame):
    users = frame(USERS, user(1))
    orders = frame(ORDERS, *order([(1, 1, 1, "Retail", "Active", 1, "2020-01-02"), (2, 1, 1, "Wholesale", "Active", 1, "2020-01-03")]))
    strict = cohort.first_last_by_type(users, orders, "2020-02-01").first()
    loose = cohort.first_last_by_type(users, orders, "2020-02-01", last_of_all=False).first()
    assert strict["last_retail"] is None and strict["last_wholesale"]["order_id"] == 2 and loose["last_retail"]["order_id"] == 1
    assert (strict["days_to_first_retail"], strict["days_since_signup"]) == (1, 31)


def test_a_hot_user_is_split_in_the_join(spark, frame):
    users = frame(USERS, *[user(i) for i in range(1, 50)])
    orders = spark.range(60000).select(
        F.col("id").alias("order_id"), F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 49 + 1).cast("long").alias("commission_user_id"),
        F.lit(1).cast("long").alias("tree_user_id"), F.lit("Retail").alias("type"), F.lit("Active").alias("status"),
        F.lit(1).cast("decimal(19,4)").alias("total"), F.lit("2020-02-01").cast("timestamp_ntz").alias("order_date"),
    )
    options = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    }
    before = {k: spark.conf.get(k, None) for k in options}
    try:
        for k, v in options.items():
            spark.conf.set(k, v)
        report = cohort.days_to_first_sale(users, orders)
        assert [(r["days_to_first_sale"], r["num"]) for r in report.collect()] == [(31, 49)]
        assert "skew=true" in report._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_downline_rollup_against_brute_force(spark):
    rnd = random.Random(3)
    sponsor = {i: rnd.randrange(0, i) if i and rnd.random() < 0.9 else None for i in range(200)}
    df = spark.createDataFrame([(i, s, i % 5) for i, s in sponsor.items()], "tree_user_id long, sponsor_id long, v long")
    want = defaultdict(Counter)
    for i in sponsor:
        up, depth = sponsor[i], 1
        while up is not None and depth <= 4:
            want[up][depth] += i % 5
            up, depth = sponsor[up], depth + 1
    got = tree.downline_rollup(df, {"v": F.col("v")}, generations=4).collect()
    assert len(got) == 200
    for r in got:
        assert [r[f"v_g{g}"] for g in range(1, 5)] == [want[r["tree_user_id"]][g] for g in range(1, 5)]


def test_downline_plan_grows_linearly(spark):
    # one written table per generation, and the base
    df = spark.range(100).select(F.col("id").alias("tree_user_id"), (F.col("id") / 3).cast("long").alias("sponsor_id"))
    scans = [tree.downline_rollup(df, {"n": F.lit(1)}, g)._jdf.queryExecution().optimizedPlan().toString().count("Relation [") for g in (3, 6)]
    assert scans == [4, 7]


def test_sponsor_edges(frame):
    book = frame("customer_id long, sponsor_id long, left_id long, right_id long", (0, None, 1, 2), (1, 0, 2, 9), (2, 7, None, None))
    edges = tree.sponsor_edges(book)
    assert sorted(map(tuple, edges.collect())) == [(1, "sponsored_by", 0), (1, "sponsoring", 2)]
    assert [r["customer_id"] for r in tree.direct_sponsor(edges, book, 1).collect()] == [0]


def test_first_seven_days_are_not_the_first_thirty(frame):
    users = frame(USERS, user(1), user(2, 1))
    upline = frame("tree_user_id long, upline_id long", (2, 1))
    orders = frame(ORDERS, *order([(1, 2, 2, "Retail", "Active", 1, "2019-12-31"), (2, 2, 2, "Retail", "Active", 2, "2020-01-03"), (3, 2, 2, "Retail", "Active", 4, "2020-01-20"), (4, 2, 2, "Retail", "Active", 8, "2020-03-20")]))
    orders = orders.withColumns({"bv_total": F.col("total"), "cv_total": F.col("total")})
    r = tree.sponsored_orders(users, upline, orders).first()
    assert (r["sponsored_orders_before_signup"], r["sponsored_orders_first_7_after_signup"], r["sponsored_orders_first_30_after_signup"]) == (1, 1, 2)
    assert (float(r["sponsored_total_first_7_after_signup"]), float(r["sponsored_total_first_30_after_signup"])) == (2.0, 6.0)
    assert r["sponsored_seconds_from_signup_to_first_order"] == -86400


def test_message_summary_of_one_and_of_many_rows_agree(spark):
    rnd = random.Random(5)
    each = spark.createDataFrame(
        [(m % 4, m, rnd.randrange(20), "2020-01-0%d" % rnd.randrange(1, 9) if rnd.random() < 0.5 else None) for m in range(10) for _ in range(30)],
        "sender_tree_user_id long, message_id long, recipient_tree_user_id long, seen string",
    ).selectExpr("*", "timestamp_ntz'2020-01-01 00:00:00' AS created", "timestamp_ntz'2020-01-01 00:00:00' AS sent", "seen AS read", "CAST(NULL AS STRING) AS undeliverable").cache()
    from tidemark.operators.nesting import nest_children

    def summary(limit):
        nested = nest_children(each, usage.MESSAGE_KEY, ["recipient_tree_user_id", "seen", "read", "undeliverable"], "recipients", limit)
        return sorted(map(str, usage.message_summary(nested).collect()))

    assert summary(1000) == summary(7)


def test_messages_without_recipients_hold_one_empty_record(frame, spark):
    from tidemark import config

    tenants = config.tenants(spark, [{"client": "north", "partition_id": 1, "partner_id": "n"}])
    messages = frame("id long, sender_id long, sender_type string", (1, 5, "User"), (2, 6, "PyrCrm::Contact"))
    to = frame("message_id long, recipient_id long, recipient_type string, delivery_type string", (1, 6, "PyrCrm::Contact", "email"), (1, 3, "PyrTree::User", "email"), (2, 5, "User", "sms"))
    users, contacts = frame("id long, tree_user_id long", (5, 50)), frame("id long, tree_user_id long", (6, 60))
    rows = {r["message_id"]: r for r in assembly.staging_emails(messages, to, users, contacts, frame("id long", (3,)), tenants, "north").collect()}
    assert (rows[1]["sender_tree_user_id"], rows[2]["sender_tree_user_id"]) == (50, 60)
    assert [r["recipient_tree_user_id"] for r in rows[1]["recipients"]] == [3, 60]
    assert len(rows[2]["recipients"]) == 1 and rows[2]["recipients"][0]["recipient_id"] is None


@pytest.mark.parametrize("text,want", [
    ("See https://x.org/about today, friends", ["today", "friends"]),
    ("Hello @bob_1 and @al: WHERE shouldn't there", ["hello", "SCREEN_NAME", "SCREEN_NAME"]),
    ("mail anna.b@example.com now-ish", ["anna.b@example.com"]),
    ("Straße façade niños ab", ["straße", "façade", "niños"]), ("x", None), (None, None), ("", None), ("ab", []),
])
def test_tokens(frame, text, want):
    from tidemark.functions.text import tokens

    assert frame("t string", (text,)).select(tokens(F.col("t")).alias("t")).first()["t"] == want


def test_phrases_join_left_to_right(spark):
    rnd = random.Random(11)
    docs = [(i, [rnd.choice("abcd") for _ in range(rnd.randrange(0, 30))]) for i in range(60)]
    pairs = {("a", "b"), ("b", "a"), ("a", "a"), ("c", "d")}

    def greedy(tokens):
        out, i = [], 0
        while i < len(tokens):
            if i + 1 < len(tokens) and (tokens[i], tokens[i + 1]) in pairs:
                out.append(f"{tokens[i]}_{tokens[i + 1]}")
                i += 2
            else:
                out.append(tokens[i])
                i += 1
        return out

    df = spark.createDataFrame(docs, "doc_id long, tokens array<string>")
    table = spark.createDataFrame([(*p, 9, 99.0) for p in pairs], "first string, second string, n long, score double")
    got = {r["doc_id"]: r["tokens"] for r in topics.join_phrases(df, table).collect()}
    assert got == {i: greedy(t) for i, t in docs}


def test_topics_and_recommender_small(spark):
    docs = spark.createDataFrame([(i, ["apple", "pear"] * 3 if i % 2 else ["truck", "wheel"] * 3) for i in range(40)], "doc_id long, tokens array<string>")
    words = topics.dictionary(docs, no_below=2, no_above=0.9)
    bags = words.transform(docs)
    model = topics.topic_model(topics.with_tfidf(bags), "tfidf", topics=2)
    assert topics.topic_terms(model, words, 2).count() == 4
    best = topics.best_topics(model, topics.with_tfidf(bags)).filter("place = 0")
    assert best.count() == 40
    ratings = spark.createDataFrame([(u, p, 1 + (u + p) % 5) for u in range(30) for p in range(20)], "user_id long, product_id long, rating int")
    rmse, predictions = recommend.cross_validate(ratings, iterations=3, rank=3)
    assert len(rmse) == 3 and all(0 < x < 4 for x in rmse)
    top = recommend.top_n(predictions).collect()
    assert max(Counter(r["user_id"] for r in top).values()) <= 5 and all(1 <= r["prediction"] <= 5 for r in top)


def test_folds_are_fitted_at_once_and_apart(spark, monkeypatch):
    seen = []
    fit = recommend.fit
    monkeypatch.setattr(recommend, "fit", lambda train, blocks=10, **o: seen.append((train, blocks)) or fit(train, blocks=blocks, **o))
    pairs = [(u, f"p{p}", 1 + (u * p) % 5) for u in range(24) for p in range(18) if (u + p) % 4]
    ddl = "user_id long, product_id string, rating int"
    ratings = spark.createDataFrame([*pairs, (None, "p1", 3), (2, None, 3), pairs[0]], ddl)
    rmse, found = recommend.cross_validate(ratings, iterations=3, rank=3)
    # one fit, in which a vector only goes to blocks of its own fold
    (train, blocks), = seen
    assert blocks % 3 == 0 and blocks < 30
    rows = train.collect()
    assert len(rows) == 2 * (len(pairs) + 1) and all(r["_u"] % 3 == r["_p"] % 3 for r in rows)
    assert sorted(map(tuple, found.select("user_id", "product_id", "rating").collect())) == sorted([*pairs, pairs[0]])
    # what a fold has not seen does not move its estimates
    held = {(r["user_id"], r["product_id"]) for r in found.collect() if r["fold"] == 1}
    other = [(u, p, 6 - x if (u, p) in held else x) for u, p, x in pairs]
    other = spark.createDataFrame([*other, (None, "p1", 3), (2, None, 3), other[0]], ddl)
    _, again = recommend.cross_validate(other, iterations=3, rank=3)
    of = lambda df: sorted((r["user_id"], r["product_id"], r["prediction"]) for r in df.filter("fold = 1").collect())
    assert [x[:2] for x in of(found)] == [x[:2] for x in of(again)] and all(abs(a[2] - b[2]) < 1e-3 for a, b in zip(of(found), of(again)))
    before = [((r["prediction"] - r["rating"]) ** 2, r["fold"]) for r in found.collect()]
    for f in range(3):
        own = [e for e, of_fold in before if of_fold == f]
        assert abs(rmse[f] - (sum(own) / len(own)) ** 0.5) < 1e-9


def test_a_fold_without_ratings_to_learn_from_is_refused(spark):
    with pytest.raises(ValueError, match="learn"):
        recommend.cross_validate(spark.createDataFrame([(1, 1, 5)], "user_id long, product_id long, rating int"))


def test_blocks_follow_cores_and_ratings():
    assert [recommend.blocks_each(1000, 3, c) for c in (1, 8, 12, 400)] == [1, 3, 4, recommend.BLOCKS]
    assert recommend.blocks_each(30 * recommend.BLOCK_RATINGS + 1, 3, 12) == 31
    # four tasks an executor lay out a block each: at 50 bytes a rating they stay below 2.5 GB, however many ratings
    assert all(4 * 50 * ratings / recommend.blocks_each(ratings, 3, 12) < 2.5e9 for ratings in (10**7, 144 * 10**6, 10**9))


def shuffle_ids(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().keySet().mkString(",")
    return set(found.split(",")) - {""}


def test_shuffle_files_of_an_iteration_go_with_it(spark, frame):
    """A long fit keeps only the shuffles of the layout and of the last iteration."""
    rows = frame("_u int, _p int, rating float", *((u, p, float(1 + (u * p) % 5)) for u in range(12) for p in range(9)))
    before = shuffle_ids(spark)
    model = recommend.fit(rows, rank=2, iterations=9, blocks=2)
    assert len(shuffle_ids(spark) - before) <= 6
    assert model.userFactors.count() == 12


def test_a_chain_reads_its_sources_once(spark, frame):
    from tidemark.plans import chain, cohort

    users = frame("client string, tree_user_id long, created timestamp_ntz, type string", ("North", 1, "2020-01-01", "Distributor"), ("south", 2, "2020-01-01", "Distributor"))
    ddl = "commission_user_id long, tree_user_id long, order_id long, type string, status string, total double, order_date timestamp_ntz, is_autoship boolean"
    orders = frame(ddl, *((u, u, o, "Retail", "Active", 5.0, f"2020-01-0{o}", False) for u in (1, 2) for o in (2, 3, 3)), (1, 1, 9, "Retail", "Cancelled", 1.0, "2020-01-01", False))
    reads = spark.sparkContext.accumulator(0)

    def counted(x):
        reads.add(1)
        return x

    watched = orders.withColumn("order_id", F.udf(counted, "long")("order_id"))
    done = chain.run_reports(users, watched, "NORTH", {
        "first": lambda b: cohort.days_to_first_sale(b.users, b.orders), "mix": lambda b: cohort.order_mix(b.users, b.orders),
        "last": lambda b: cohort.days_to_last_sale(b.users, b.orders, "2019-01-01", "2021-01-01"),
    })
    assert [(r["days_to_first_sale"], r["num"]) for r in done["first"].collect()] == [(1, 1)]
    assert [r["count"] for r in done["mix"].collect()] == [2] and [r[0] for r in done["last"].collect()] == [2]
    assert reads.value <= orders.count()


def test_biased_factors_beat_biases_and_the_mean(frame):
    from tidemark.plans import biased

    rng = random.Random(5)
    taste = {u: [rng.gauss(0, 1) for _ in range(2)] for u in range(60)}
    kind = {p: [rng.gauss(0, 1) for _ in range(2)] for p in range(40)}
    off = {u: rng.gauss(0, 0.4) for u in range(60)}
    rating = lambda u, p: min(5.0, max(1.0, 3 + off[u] + 0.8 * sum(a * b for a, b in zip(taste[u], kind[p])) + rng.gauss(0, 0.1)))
    rows = [(u, p, rating(u, p)) for u in range(60) for p in range(40) if rng.random() < 0.7]
    got = biased.errors(frame("user_id long, product_id long, rating double", *rows), rank=3, passes=10).collect()
    assert sorted(r["fold"] for r in got) == [0, 1, 2] and sum(r["n"] for r in got) == len(rows)
    assert all(r["factors"] < 0.5 * min(r["biases"], r["constant"]) for r in got), got


def test_a_gradient_step_joins_no_rating(spark, frame):
    """A step is one join of vectors with a user's or item's links; its result is that of the errors rating by rating."""
    from tidemark.plans import biased

    rng = random.Random(9)
    rows = [(u, p, rng.choice([1.0, 2.5, 4.0, None]), rng.randrange(3)) for u in range(9) for p in range(7)] + [(1, 2, 5.0, 0), (None, 3, 2.0, 1), (4, None, 2.0, 2), (20, 1, 3.0, 1)]
    df = frame("user_id long, product_id long, rating double, fold int", *rows)
    means, users, items = biased.fit(df, rank=2, passes=1)
    start = {name: {(r["train"], r[key]): list(r)[2:] for r in side.collect()} for name, key, side in zip("ui", ("user_id", "product_id"), biased.fit(df, rank=2, passes=0)[1:])}
    mean, got = {r["train"]: r["mean"] for r in means.collect()}, {"u": users, "i": items}
    for mine, other, key in (("u", "i", "user_id"), ("i", "u", "product_id")):
        moved = {}
        for (train, i), v in start[mine].items():
            near = [(r, start[other].get((train, p if mine == "u" else u))) for u, p, r, f in rows if f != train and (u if mine == "u" else p) == i and u is not None and p is not None]
            left = [(r - mean[train] - v[0] - w[0] - v[1] * w[1] - v[2] * w[2], w) for r, w in near if r is not None]
            c = sum(w[1] ** 2 + w[2] ** 2 for _, w in near)
            pace = [1 / (2 * len(near) * 1.1 + 2), *[1 / (2 * (c + 0.1 * len(near)) + 2)] * 2]
            g = [sum(e for e, _ in left), *(sum(e * w[j] for e, w in left) for j in (1, 2))]
            moved[train, i] = [x + s * (d - 0.1 * len(near) * x) for x, s, d in zip(v, pace, g)]
        start[mine] = moved
        found = {(r["train"], r[key]): list(r)[2:] for r in got[mine].collect()}
        assert found.keys() == moved.keys() and all(abs(a - b) < 1e-9 for k in moved for a, b in zip(found[k], moved[k]))
    links = biased._links(df, "product_id", "user_id", 4)
    step = biased._step(links, biased._start(df, "product_id", "item", 3, 2, 7), biased._start(df, "user_id", "user", 3, 2, 7), "user_id", 4, mean, 3, 2, 0.1, 2.0)
    assert step._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


def test_passes_leave_only_the_newest_on_disk(spark, frame, monkeypatch, tmp_path):
    """Neither vectors nor shuffle files of earlier passes stay, so disk does not grow with the passes."""
    import uuid

    from tidemark import session
    from tidemark.plans import biased

    rows = frame("user_id long, product_id long, rating double, fold int", *((u, p, float(1 + u * p % 5), (u + p) % 3) for u in range(9) for p in range(7)))
    top = tmp_path / "kept"
    monkeypatch.setattr(session, "work_dir", lambda spark, name: f"{top}/{name}-{uuid.uuid4().hex}")
    _, users, items = biased.fit(rows, rank=2, passes=3)
    folders = [p.name.split("-")[0] for p in top.iterdir()]
    assert (users.count(), items.count()) == (27, 21)
    assert (folders.count("users"), folders.count("items")) == (1, 1)
    steps = session.Steps("step")
    for n in range(3):
        before = shuffle_ids(spark)
        found = steps.cut(spark.range(100 + n).groupBy(F.col("id") % 7).count())
        assert not shuffle_ids(spark) - before and found.count() == 7
    assert spark.conf.get(session.Steps.CLEAN) == "false"


def test_a_phrase_table_counts_words_and_pairs_once(spark):
    docs = spark.createDataFrame([(i, ["apple", "pear", f"word{i % 7}"] * 2) for i in range(40)] + [(90, []), (91, ["apple"])], "doc_id long, tokens array<string>")
    reads = spark.sparkContext.accumulator(0)

    def counted(x):
        reads.add(1)
        return x

    watched = docs.withColumn("tokens", F.udf(counted, "array<string>")("tokens"))
    got = {(r["first"], r["second"]): (r["n"], r["score"]) for r in topics.phrase_table(watched, threshold=0.01).collect()}
    # words: two and seven; pairs: apple pear, pear word0..6, word0..6 apple; of each pair's words one is as rare as it
    assert got["apple", "pear"] == (80, 75 * 24 / (81 * 80)) and got["pear", "word0"] == (12, 7 * 24 / (80 * 12))
    # one pass for the words and one for the pairs, whose plan names the tokens three times
    assert reads.value <= 4 * docs.count()
    assert topics.phrase_table(docs.filter("doc_id < 0")).count() == 0 and topics.phrase_table(docs.filter("doc_id > 80")).count() == 0


def test_documents_of_a_topic_model_are_dealt_over_the_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    sizes = lambda df: [len(x) for x in df.rdd.glom().collect()]
    many = sizes(topics.dealt(spark.range(0, 30_000, 1, cores + 1)))
    assert len(many) == 3 * cores and sum(many) == 30_000 and max(many) < 1.2 * min(many)
    assert sizes(topics.dealt(spark.range(0, 900, 1, 1))) == [900] and len(sizes(topics.dealt(spark.range(0, 30_000, 1, 40)))) == 40
