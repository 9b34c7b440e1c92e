"""Genre rules as data: the trigram join against plain substring search, with rules of any number."""

import random

from encore.operators import genres as G


def plain(artists, rules):
    out = []
    for n, (i, own) in enumerate(artists):
        score = {}
        for g in own:
            for _, cat, ordinal, weight, pattern in rules:
                if g is not None and pattern is not None and pattern in g.lower():
                    score[cat, ordinal] = score.get((cat, ordinal), 0) + weight
        out += [(i, c, s) for (c, _), s in score.items() if s > 0]
    return sorted(out, key=str)


def table(spark, artists):
    return spark.createDataFrame(artists, "id string, genres array<string>").repartition(3)


def test_odd_patterns_against_plain_search(spark):
    artists = [("a", ["Pop", "pop", "k-pop", "pop"]), ("a", ["pop"]), ("b", ["", "x", "Ärger pop"]), ("c", [None, "deep house"]), ("d", []), ("e", ["aaaa", "aab"]),
               ("f", ["𝔸𝔹c pop"]), (None, ["pop"])]
    rules = [(0, "one", 0, 3, "pop"), (1, "one", 0, 2, "pop"), (2, "two", 1, 5, "p"), (3, "two", 1, 1, "op"), (4, "three", 2, 7, ""), (5, "three", 2, 1, None),
             (6, "one", 0, 4, "aaa"), (7, "two", 1, 9, "house of pop"), (8, "one", 0, 1, "𝔸𝔹c"), (9, "four", 3, 0, "pop"), (10, "two", 1, 6, "rge"), (11, "two", 1, 6, "xyz")]
    frame = spark.createDataFrame(rules, G.RULES_DDL)
    got = sorted((tuple(r) for r in G.genre_scores_by_rules(table(spark, artists), frame).select("id", "category", "score").collect()), key=str)
    assert got == plain(artists, rules)
    primary = sorted((tuple(r) for r in G.primary_genre_by_rules(table(spark, artists), frame).collect()), key=str)
    best = []
    for i, own in artists:
        score = {}
        for _, c, s in plain([(i, own)], rules):
            score[c] = s
        best.append((i, max(score, key=lambda c: (score[c], -["one", "two", "three", "four"].index(c))) if score else "other"))
    assert primary == sorted(best, key=str)


def test_fixed_rules_score_as_the_expression_does(spark):
    words = sorted({p for _, _, ps in G.GENRE_RULES for p in ps})
    rng = random.Random(2)
    artists = [(str(i), [" ".join(rng.sample(words, 2)).title() for _ in range(rng.randrange(4))]) for i in range(200)]
    df = table(spark, artists)
    got = sorted(tuple(r) for r in G.genre_scores_by_rules(df, G.rules_table(spark)).select("id", "category", "score").collect())
    assert got == sorted(tuple(r) for r in G.genre_scores(df).collect())


def test_a_hundred_thousand_patterns_without_a_nested_loop(spark):
    rules = spark.range(100_000).selectExpr("cast(id as int) as rule_no", "concat('c', id % 9) as category", "cast(id % 9 as int) as category_ord",
                                            "cast(1 + id % 5 as int) as weight", "concat('g', substr(sha2(cast(id as string), 256), 1, 3 + cast(id % 4 as int))) as pattern")
    rng = random.Random(3)
    known = [r.pattern for r in rules.where("rule_no % 500 = 0").collect()]
    artists = [(str(i), [f"{rng.choice(known)} {rng.choice(known)}"]) for i in range(40)] + [("none", ["zzz"])]
    df = G.genre_scores_by_rules(table(spark, artists), rules)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert sorted((tuple(r) for r in df.select("id", "category", "score").collect()), key=str) == plain(artists, [tuple(r) for r in rules.collect()])


def test_empty_tables(spark):
    none = spark.createDataFrame([], G.RULES_DDL)
    assert G.genre_scores_by_rules(table(spark, [("a", ["pop"])]), none).count() == 0
    assert [tuple(r) for r in G.primary_genre_by_rules(table(spark, [("a", ["pop"])]), none).collect()] == [("a", "other")]
    assert G.primary_genre_by_rules(table(spark, []), G.rules_table(spark)).count() == 0
