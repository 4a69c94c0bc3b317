"""Each operator on odd input (nulls, empty and long texts, ties, clashing columns, no rows), and what its
method promises beyond the registered query."""

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from txnguard.llm import anchors, archive, cascade, dart, mixing, ordinal, sketch, spans, suffix, toxic, words
from txnguard.session import shared_folder


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# ---- near duplicates


def test_near_duplicates_on_odd_rows(spark, odd_docs, no_docs):
    rows = dart.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    story = {r.class_id for r in rows if r.doc_id in (1, 2, 9)}
    assert story == {1}
    assert {r.class_id for r in rows if r.doc_id in (7, 8)} == {7}
    empty = [r.class_key for r in rows if r.doc_id == 4]
    assert sum(r.class_key == empty[0] for r in rows) == 3  # null texts count as empty
    assert dart.near_duplicates(no_docs).count() == 0
    kept = dart.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == len({r.class_key for r in rows})
    assert dart.one_of_each(no_docs).count() == 0


def test_agreement_of_signatures_is_the_weighted_similarity():
    rng = np.random.default_rng(3)
    element = rng.integers(1, 1 << 62, 300, dtype=np.uint64)
    left, right = rng.uniform(0.2, 3, 300), rng.uniform(0.2, 3, 300)
    k = 4096
    both = np.concatenate([element, element])
    row = np.repeat([0, 1], 300)
    out = dart.signatures(both, np.concatenate([left, right]), row, 2, k)
    expected = np.minimum(left, right).sum() / np.maximum(left, right).sum()
    assert abs((out[0] == out[1]).mean() - expected) < 0.03
    assert (dart.signatures(element, left, np.zeros(300, int), 1, k)[0] == out[0]).all()


def test_links_between_strays_are_found(spark):
    """A chain and many loose variants of one text: whatever shares a bucket, no link may be lost."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(150):
        words = list(base)
        for k in rng.choice(80, rng.integers(0, 7), replace=False):
            words[k] = f"v{rng.integers(3)}"
        rows.append((i, " ".join(words)))
    got = {r.doc_id: r.class_id for r in dart.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.near_classes(rows)


# ---- fingerprints


def test_fingerprints_on_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.where("doc_id IS NULL OR doc_id NOT IN (2, 3)")
    got = sorted(map(repr, map(tuple, sketch.compare_with_next(docs).collect())))
    assert got == sorted(map(repr, brute.fingerprints(pairs(docs))))
    assert sketch.compare_with_next(odd_docs).count() == odd_docs.count()
    assert sketch.compare_with_next(no_docs).count() == 0


@pytest.mark.parametrize("scale", [1, 2, 8])
def test_fingerprints_of_short_texts(spark, scale):
    """Alike only if the texts are, however few hashes are kept; line ends beyond ASCII are part of words."""
    texts = [f"{k} short text" for k in range(30)] + ["", " ", "a b \u0085", "a b \u2028", "one two three four five six\n", "x " * 40]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {tuple(r) for r in sketch.compare_with_next(docs, scale=scale).collect()}
    assert found == set(brute.fingerprints(rows, scale))
    assert {r[6] for r in found if 1 < r[0] < 30} == {0.0}


def test_neighbours_across_ranges(spark, monkeypatch):
    monkeypatch.setattr(sketch, "GROUP", 3)
    rows = [(i * i * 7 - 50, f"text number {i} of a few words more") for i in range(25)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in sketch.compare_with_next(docs).collect()} == set(brute.fingerprints(rows))


def test_ranges_are_cut_by_count(spark, monkeypatch):
    monkeypatch.setattr(sketch, "GROUP", 20)
    ends = [-(1 << 63), (1 << 63) - 1, 1 << 62]
    rows = [(i, f"text number {i} of a few words more") for i in [*range(800), *ends]]
    header = "one header that is common to all texts and longer than any prefix that one might look at "
    rows += [(None, f"{header}{i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    source = docs.select(F.col("doc_id").alias("id"), "text")
    sizes = [r["count"] for r in source.groupBy(sketch._ranges(source)).count().collect()]
    assert len(sizes) > 25 and max(sizes) < 100
    assert sorted(map(repr, map(tuple, sketch.compare_with_next(docs).collect()))) == sorted(map(repr, brute.fingerprints(rows)))


def test_merge_and_containment(spark):
    words = [f"w{i}" for i in range(4000)]
    df = spark.createDataFrame([(" ".join(words), " ".join(words[:400]))], "a string, b string")
    a, b = (sketch.sketch(F.col(c), scale=8) for c in "ab")
    row = df.select(a.alias("a"), b.alias("b")).select(
        sketch.containment(F.col("b"), F.col("a")), sketch.containment(F.col("a"), F.col("b")), (sketch.merge(F.col("a"), F.col("b")) == F.col("a"))
    ).first()
    assert row[0] == 1 and abs(row[1] - 0.1) < 0.03 and row[2]


# ---- repeated passages


def test_repeats_on_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.where("doc_id IS NOT NULL")
    got = anchors.remove_repeats(docs).drop("kept")
    assert sorted(map(tuple, got.collect())) == sorted(brute.without_repeats(pairs(docs)))
    assert anchors.remove_repeats(odd_docs).where("doc_id IS NULL AND n_words = n_removed").count() == 2
    assert anchors.remove_repeats(no_docs).count() == 0


def test_repeats_of_planted_passages(spark):
    rng = np.random.default_rng(2)
    passages = [[f"p{rng.integers(9)}" for _ in range(rng.integers(10, 30))] for _ in range(5)]
    rows = []
    for i in rng.permutation(60):
        words = [f"q{rng.integers(50)}" for _ in range(rng.integers(0, 60))]
        for _ in range(rng.integers(0, 3)):
            at = rng.integers(0, len(words) + 1)
            words[at:at] = passages[rng.integers(5)]
        rows.append((int(i), " ".join(words)))
    rows += rows[:3]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, anchors.remove_repeats(docs, keep_text=False).collect())) == sorted(brute.without_repeats(rows))


def test_cover_must_be_whole():
    with pytest.raises(ValueError):
        anchors.difference_cover(7, (0, 1, 2))


# ---- archive


def pages(spark):
    same = "x" * 1000
    rows = [(1, "http://a/", same, 1), (2, "http://b/\r\nX: y", same, 1), (2, "http://b/\r\nX: y", same, 1), (3, None, None, 1),
            (4, "http://c/", "short", 1), (5, "http://d/", "short", 1), (None, "http://e/", same, 1), (6, "u", "line\r\n\r\nWARC/1.1\r\n\r\né", 1)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest int")


def test_archive_round_trip(spark, tmp_path):
    store = archive.write_archive(pages(spark), f"{shared_folder(spark)}/archive-{tmp_path.name}")
    got = archive.read_archive(spark, store)
    assert got.where("NOT verified").count() == 0
    rows = sorted(((r.page_id or 0, r.record_type, r.refers_to, bytes(r.payload).decode()) for r in got.collect()))
    same, odd = "x" * 1000, "line\r\n\r\nWARC/1.1\r\n\r\né"
    assert rows == sorted(
        [(0, "revisit", 2, same), (1, "revisit", 2, same), (2, "response", None, same), (2, "response", None, same), (3, "response", None, ""),
         (4, "response", None, "short"), (5, "response", None, "short"), (6, "response", None, odd)], key=lambda r: (r[0], r[1], r[2] or 0)
    )
    assert spark.read.parquet(store.payloads).count() == 4
    out = f"{shared_folder(spark)}/warc-{tmp_path.name}"
    archive.export_warc(spark, store, out, records_per_file=3)
    back = {(r.header, bytes(r.block)) for r in archive.read_warc(spark, out).collect()}
    exact = {bytes(r.record) for r in archive.reconstruct(spark, store).collect()}
    assert {h.encode() + b + b"\r\n\r\n" for h, b in back} == exact


def test_damage_is_noticed_and_no_pages_are_fine(spark, tmp_path):
    store = archive.write_archive(pages(spark), f"{shared_folder(spark)}/damaged-{tmp_path.name}")
    broken = spark.read.parquet(store.payloads).withColumn("payload", F.expr("CAST('other' AS binary)"))
    broken.write.parquet(f"{store.payloads}-broken")
    bad = archive.Archive(f"{store.payloads}-broken", store.records)
    assert archive.read_archive(spark, bad).where("verified").count() == 0
    none = archive.write_archive(pages(spark).limit(0), f"{shared_folder(spark)}/none-{tmp_path.name}")
    assert archive.read_archive(spark, none).count() == 0


# ---- quality, toxicity


def test_quality_on_odd_rows(spark, odd_docs, no_docs):
    ratings = spark.createDataFrame([(1, 0), (5, 1), (10, 2), (7, None), (None, 1), (9, 7)], "doc_id long, grade int")
    model = ordinal.train(odd_docs, ratings, grades=3)
    rows = ordinal.grade(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    assert all(1 >= r.at_least[0] >= r.at_least[1] >= r.at_least[2] >= 0 and 0 <= r.expected <= 2 for r in rows)
    assert ordinal.select(odd_docs, model, 1).columns == odd_docs.columns
    assert ordinal.grade(no_docs, model).count() == 0
    assert ordinal.grade(odd_docs, ordinal.train(odd_docs, ratings.limit(0), grades=3)).count() == len(rows)


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(1)
    grade = rng.integers(0, 4, 400)
    texts = [" ".join(rng.choice(["good", "bad", "so"], 30, p=[0.1 + 0.2 * g, 0.8 - 0.2 * g, 0.1])) for g in grade]
    model = ordinal.fit(texts, grade, np.ones(400), 4)
    assert (np.diff(model.thresholds) > 0).all()
    p = ordinal._upper(ordinal.scores(model.weights, pa.array(texts)), model.thresholds)
    assert np.corrcoef(p[:, 1:4].sum(axis=1), grade)[0, 1] > 0.9


def toxic_sample(spark):
    rng = np.random.default_rng(7)
    rows, labels = [], []
    for i in range(300):
        words = [f"word{rng.integers(200)}" for _ in range(40)]
        bad = i % 4 == 0
        if bad:
            words[rng.integers(40)] = rng.choice(["blarg", "Frotz!", "zonked"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")


def test_toxic_spans(spark, odd_docs, no_docs):
    docs, labels = toxic_sample(spark)
    model = toxic.train(docs, labels)
    asked = spark.createDataFrame([(1, "é this is frotz, blarg and fine"), (2, "all is fine")], "doc_id long, text string")
    rows = {r.row.doc_id: r for r in toxic.score(asked, model).collect()}
    found = "é this is frotz, blarg and fine"
    assert "frotz" in "".join(found[s.start : s.end] for s in rows[1].spans)
    assert rows[1].score > 0.5 > rows[2].score and rows[2].spans == []
    assert toxic.score(odd_docs, model).count() == odd_docs.count()
    assert toxic.reject_toxic(odd_docs, model).columns == odd_docs.columns
    assert toxic.score(no_docs, model).count() == 0
    nothing = toxic.train(docs, labels.limit(0))
    assert toxic.score(odd_docs, nothing).where("score IS NULL OR score < 0 OR score > 1").count() == 0


def rare_toxic(seed, n=2400):
    """Half of the texts have one of 200 toxic words, which look like any other word."""
    rng, bad = np.random.default_rng(seed), np.arange(n) % 2 == 0
    share = 1 / np.arange(1, 2001)
    texts = []
    for toxic_text in bad:
        words = [f"{x * 7919 % 999979:06d}" for x in rng.choice(2000, 40, p=share / share.sum())]
        if toxic_text:
            words[rng.integers(40)] = f"{rng.integers(1, 201) * 104729 % 999983:06d}"
        texts.append(" ".join(words))
    return texts, bad


def test_many_rare_toxic_words_are_learned():
    model = toxic.fit(*rare_toxic(1), np.ones(2400))
    texts, bad = rare_toxic(2)
    words = toxic.read(pa.array(texts))
    p, _ = toxic.marginals(toxic._score(model.weights, toxic.features(words)), model.change, words)
    found = toxic.document_features(p, words) @ model.document > 0
    assert found[bad].mean() > 0.8 and found[~bad].mean() < 0.05


def test_texts_that_begin_alike_are_all_learned_from(spark):
    rows = [(i, "a notice that stands at the head of each and every text of this source: " + f"w{i // 2}", i % 4 // 2) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    texts, _, _ = toxic.training_rows(docs, docs, "doc_id", "text", "doc_id", "toxic", 100)
    assert sorted(texts) == sorted({t for _, t, _ in rows})


def test_marginals_are_those_of_all_paths():
    rng = np.random.default_rng(0)
    score, change = rng.normal(size=5), rng.normal(size=(2, 2))
    words = toxic.read(pa.array(["a b c d e"]))
    p, seen = toxic.marginals(score, change, words)
    total, each, moves = 0.0, np.zeros(5), np.zeros((2, 2))
    for path in np.ndindex(*[2] * 5):
        w = np.exp(sum(score[t] * s for t, s in enumerate(path)) + sum(change[a, b] for a, b in zip(path, path[1:], strict=False)))
        total += w
        each += w * np.array(path)
        for a, b in zip(path, path[1:], strict=False):
            moves[a, b] += w
    assert np.allclose(p, each / total) and np.allclose(seen, moves / total)


# ---- mixing


def test_mix_on_odd_rows(spark, odd_docs, no_docs):
    plan = mixing.plan_mix(odd_docs, carried=odd_docs.columns)
    rows = plan.collect()
    assert len(rows) == odd_docs.count()
    assert all(0 <= r.taken <= 2 * r["size"] for r in rows)
    per = {}
    for r in rows:
        per.setdefault(r.row.source, []).append(r)
    for group in per.values():
        assert sum(r.taken for r in group) == round(group[0].target)
    mixed = mixing.expand(plan).withColumn("n", F.regexp_count("mixed_text", F.lit(mixing.WORD)))
    assert mixed.agg(F.sum("n")).first()[0] == sum(r.taken for r in rows)
    again = mixing.plan_mix(odd_docs.repartition(5), carried=odd_docs.columns).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))
    assert mixing.plan_mix(no_docs, carried=["doc_id"]).count() == 0


def test_water_filling_shares_the_excess(spark):
    sizes = spark.createDataFrame([("a", 10, 3.0), ("b", 100, 1.0), ("c", 1000, 2.0), ("d", 0, 1.0)], "source string, source_size long, weight double")
    got = {r.source: r.target for r in mixing.water_fill(sizes).collect()}
    assert got["a"] == 20 and got["b"] == 200 and got["d"] == 0 and abs(got["c"] - (1.5 * 1110 - 220)) < 1e-6
    names = spark.createDataFrame([("b",), (None,), ("B",), ("é",), ("a",)], "source string")
    weights = {r.source: r.weight for r in mixing.cycled_weights(names).collect()}
    assert weights == {"B": 3.0, "a": 1.0, "b": 2.0, "é": 3.0, None: 1.0}


# ---- benchmark


ITEMS = [(1, "the quick brown fox jumps over the lazy dog and runs far away from all"), (2, "Two, words"), (3, None), (None, "other text"), (4, "")]


def test_benchmark_on_odd_rows(spark, odd_docs, no_docs, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    expected = {}
    for (i, t) in pairs(odd_docs):
        expected.setdefault(i, set()).add(brute.benchmark_hits([(i, t)], ITEMS)[i][:3])

    def check(found):
        rows = found.collect()
        assert len(rows) == odd_docs.count()
        assert all((r.n_words, r.n_hit, len(r["items"])) in expected[r.doc_id] for r in rows)
        return sorted((str(r.doc_id), r.n_words, r.n_hit, tuple(r["items"]), r.longest) for r in rows)

    one = check(suffix.find_matches(odd_docs, items))
    monkeypatch.setattr(suffix, "BLOCK_BYTES", 5)
    assert check(suffix.find_matches(odd_docs, items)) == one
    assert suffix.find_matches(odd_docs, items.limit(0)).where("n_hit > 0").count() == 0
    assert suffix.find_matches(no_docs, items).count() == 0
    kept = suffix.decontaminate(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.where("doc_id IN (1, 2, 9)").count() == 0


def test_locations_of_the_longest_matches(spark):
    text = "zero " + ITEMS[0][1].upper() + " the end"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = suffix.find_matches(docs, spark.createDataFrame(ITEMS[:1], "item_id long, text string")).first()
    assert row.longest == 15
    assert [(m["item"], m.item_word, m.doc_word, m.n_words) for m in row.matches] == [("1", 0, 1, 15)]


def test_matches_along_every_item_that_shares_a_prefix(spark):
    head, tail = [f"h{i}" for i in range(30)], [f"b{i}" for i in range(70)]
    items = [(1, " ".join([*head, *(f"a{i}" for i in range(20))])), (2, " ".join(head + tail)), (3, " ".join(["x", *head[5:], *tail[:3]]))]
    docs = [(1, " ".join(["zero", *head, *tail, "end", *head[2:20]])), (2, " ".join(tail[:20]))]
    expected = {}
    for d, text in docs:
        w, found = text.split(), set()
        for i, t in items:
            v = t.split()
            for x in range(len(w)):
                for y in range(len(v)):
                    n = 0
                    while x + n < len(w) and y + n < len(v) and w[x + n] == v[y + n]:
                        n += 1
                    if n >= 13 and (not x or not y or w[x - 1] != v[y - 1]):
                        found.add((str(i), y, x, n))
        expected[d] = found
    found = suffix.find_matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    rows = {r.doc_id: r for r in found.collect()}
    assert rows[1].longest == 100
    for d, r in rows.items():
        got = [(m["item"], m.item_word, m.doc_word, m.n_words) for m in r.matches]
        assert len(got) == len(set(got)) and set(got) == expected[d] and r.longest == max(m[3] for m in got)


# ---- personal data


def test_personal_data_on_odd_rows(spark, odd_docs, no_docs):
    model = spans.train(odd_docs)
    rows = spans.find(odd_docs, model, replace=True).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert [(s.kind, s.start, s.end) for s in r.spans if s.base] == brute.personal(r.row.text)
    masked = spans.mask(odd_docs, model, length_col="n_chars")
    assert masked.columns == odd_docs.columns
    eleven = masked.where("doc_id = 11").first()
    assert eleven.text == "mail <EMAIL>, <PHONE>, <IP> and <CARD>" and eleven.n_chars == len(eleven.text)
    assert masked.where("text IS NULL").count() == odd_docs.where("text IS NULL").count()
    assert spans.find(no_docs, spans.train(no_docs)).count() == 0


@pytest.mark.parametrize(
    "text",
    ["a@b.c@d.e", "..@x.y a%@b-c.d.e.", "1.2.3.4.5.6.7.8", "256.1.1.1 001.02.3.4", "4111 1111-1111 1111 4", "5  55 55", "+1 (017) 555-7713 (",
     "+123456789012345 +1 2", "0" * 5000 + ".1.2.3", "x" * 20000 + "@", "١٢٣ @a.b", "+1-555-0100-22 33@y.z", "4111111111111111@host.example.com"],
)
def test_patterns_are_as_stated(text):
    assert spans.base_spans(text) == brute.personal(text)


def test_marginals_of_spans_are_those_of_all_cuts():
    number = {}
    grid = spans.lattice(number, ["1234567", " ", "8", "@", "x"], " ", " ", grow=True)
    weights = np.random.default_rng(4).normal(size=(len(number) + 1, len(spans.KINDS)))
    scores = weights[grid.features].sum(axis=1)

    def cuts(at):
        if at == grid.size:
            yield 1.0, []
            return
        for w, rest in cuts(at + 1):
            yield w, rest
        for k, (i, j) in enumerate(grid.pairs):
            if i == at:
                for kind in range(len(spans.KINDS)):
                    for w, rest in cuts(j):
                        yield w * np.exp(scores[k, kind]), [(k, kind), *rest]

    ways = list(cuts(0))
    total = sum(w for w, _ in ways)
    p, log_total = spans.marginals(grid, weights)
    expected = np.zeros_like(p)
    for w, found in ways:
        for k, kind in found:
            expected[k, kind] += w / total
    assert np.allclose(p, expected) and np.isclose(np.exp(log_total), total)
    best = max(ways, key=lambda x: x[0])[1]
    assert [(k, kind) for _, _, kind, k in spans.decode(grid, weights)] == best


def test_the_field_finds_what_patterns_miss():
    rng = np.random.default_rng(9)
    texts = [f"call +1 ({rng.integers(100, 999)}) 555-{rng.integers(1000, 9999)} or write a{i}.{i}@mail{i}.example.com" for i in range(60)]
    texts += [f"number {i} of {rng.integers(10**11)} is plain" for i in range(60)]
    model = spans.fit(texts)
    judge = spans.judge_with(model)
    text = "call 1 (487) 555-7209 today"
    assert spans.base_spans(text) == [] and spans.added_spans(text, [], judge) == [("phone", 5, 21)]
    assert spans.added_spans("nothing 12345 here", [], judge) == []


# ---- URL filters


def keys(spark, names):
    return spark.createDataFrame([(x,) for x in names], "key string")


@pytest.mark.parametrize("n_listed, n_all", [(0, 50), (50, 50), (400, 3000), (2500, 3000), (1, 3000)])
def test_cascade_is_exact_over_its_universe(spark, n_listed, n_all):
    names = [f"host{i}.example" for i in range(n_all)]
    universe = keys(spark, [*names, None, names[0]])
    built = cascade.build(keys(spark, names[:n_listed]), universe)
    got = {r["key"]: r.listed for r in cascade.mark(universe, "key", built).collect()}
    assert got == {**{x: i < n_listed for i, x in enumerate(names)}, None: False}
    joined = cascade.build(keys(spark, names[:n_listed]), universe, most_words=0)
    assert {r["key"]: r.listed for r in cascade.mark(universe, "key", joined).collect()} == got


def test_urls_on_odd_rows(spark):
    urls = ["http://A.Example.com/en/x?q", "https://www.example.com/en/", "no scheme", "", None, "http://x.net", "http://x.net/es/1#f",
            "http://x.net/en/", "://h", "a://b://c/d", "http://example.com/", "http://notexample.com/en/", "http://É.net/fr/?"]
    rows = [(n, u, "h", "p") for n, u in enumerate(urls)] + [(None, urls[0], "h", "p"), (0, urls[0], "h", "p")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, path string")
    from txnguard.llm.queries import URL_RULES

    got = {r.page_id: tuple(r)[1:] for r in cascade.judge(df, URL_RULES).collect()}
    assert got[0] == ("a.example.com", "/en/x", "example.com/en/", True, "block")
    assert got[1][2:5:2] == ("www.example.com/en/", "allow")
    assert got[2][:3] == got[3][:3] == got[4][:3] == ("", "", None)
    assert got[5] == ("x.net", "", None, False, "allow") and got[6][2] == "net/es/" and got[7] == ("x.net", "/en/", None, False, "allow")
    assert got[8][:2] == ("h", "") and got[9][:2] == ("b:", "//c/d") and got[10][2] == "com/" and got[11][2] == "com/"
    assert got[12][:3] == ("É.net", "/fr/", "net/fr/")
    assert cascade.judge(df.limit(0), URL_RULES).count() == 0


def test_a_long_list_of_rules(spark):
    """A hundred thousand rules, told from the URLs' own keys; no URL's verdict depends on another."""
    rng = np.random.default_rng(11)
    hosts = [f"h{i}.d{i % 400}.org" for i in range(3000)]
    rules = {}
    for i in range(100_000):
        host = hosts[rng.integers(3000)] if i % 3 else f"d{i % 400}.org"
        rules[host + f"/p{rng.integers(2000)}/"[: rng.integers(1, 7)]] = (("allow", "block")[int(rng.integers(2))], host)
    table = spark.createDataFrame([(v, h, k[len(h) :]) for k, (v, h) in rules.items()], "verdict string, host string, path string")
    urls = [(i, f"https://{hosts[rng.integers(3000)]}/p{rng.integers(2500)}/x?y=1") for i in range(3000)] + [(i, f"http://other{i}.com/p1/") for i in range(3000, 3100)]
    got = {r.page_id: (r.rule, r.verdict) for r in cascade.judge(spark.createDataFrame(urls, "page_id long, url string"), table).collect()}
    expected = {}
    for i, url in urls:
        host, path = url.split("://")[1].split("?")[0].split("/", 1)
        labels = host.split(".")
        fits = [k for t in (".".join(labels[n:]) for n in range(3)) for m in range(len(path) + 2) if (k := t + f"/{path}"[:m]) in rules]
        rule = max(fits, key=lambda k: (len(k), k), default=None)
        expected[i] = (rule, rules[rule][0] if rule else "allow")
    assert got == expected
    assert len({v for _, v in got.values()}) == 2 and sum(r is not None for r, _ in got.values()) > 1000


def test_spans_across_the_pieces_of_a_long_line():
    rng = np.random.default_rng(9)
    model = spans.fit([f"call +1 ({rng.integers(100, 999)}) 555-{rng.integers(1000, 9999)} today" for _ in range(60)])
    judge = spans.judge_with(model)
    numbers = [f"1 ({rng.integers(100, 999)}) 555-{rng.integers(1000, 9999)}" for _ in range(200)]
    apart = [len(spans.added_spans(f"call {x} today", [], judge)) for x in numbers]
    line = "; ".join(numbers)
    found = spans.added_spans(line, [], judge)
    assert sum(apart) == 200 and [line[s:e] for _, s, e in found] == numbers


def test_an_item_of_very_many_different_words(spark):
    """More than 21 bits can number, in one item that is larger than a block."""
    n = (1 << 21) + 5
    item = " ".join(f"w{i}" for i in range(n))
    passage = " ".join(f"w{i}" for i in range(n - 40, n - 10))
    docs = spark.createDataFrame([(1, f"before {passage} after"), (2, "w1 w2 w4")], "doc_id long, text string")
    items = spark.createDataFrame([("a", item)], "item_id string, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"], r.longest) for r in suffix.find_matches(docs, items).collect()}
    assert got == {1: (32, 30, ["a"], 30), 2: (3, 0, [], 0)}


def test_the_sample_of_a_repeated_id_is_the_same_in_any_order(spark):
    rows = [(1, f"text {i} of one id") for i in range(40)] + [(k, f"text {k} of its own") for k in range(2, 30)]
    ratings = spark.createDataFrame([(k, k % 3) for k in range(1, 30)], "doc_id long, grade int")
    models = [ordinal.train(spark.createDataFrame(r, "doc_id long, text string").repartition(5), ratings, grades=3, sample=4) for r in (rows, rows[::-1])]
    assert (models[0].weights == models[1].weights).all() and (models[0].thresholds == models[1].thresholds).all()


def test_words_whose_hashes_collide_are_told_apart(spark):
    """The Thue-Morse words of a, b and of b, a have the same polynomial hash, whatever its base."""
    one = "".join("ab"[bin(k).count("1") % 2] for k in range(1024))
    other = one.translate(str.maketrans("ab", "ba"))
    hashes = words.find_words(pa.array([one, other])).hash
    assert hashes[0] == hashes[1]
    line = " ".join(f"w{k}" for k in range(12))
    rows = [(1, f"{line} {one} tail"), (2, f"{line} {other} tail"), (3, f"head {line}  {one}"), ((1 << 63) - 1, f"x {line} {one} y"), (None, f"{line}\n{one}")]
    got = {r.doc_id: tuple(r)[1:] for r in anchors.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), keep_text=False).collect()}
    expected = {i: tuple(x) for i, *x in brute.without_repeats([(1 << 63 if i is None else i, t) for i, t in rows])}
    assert got == {None if i == 1 << 63 else i: x for i, x in expected.items()}
    assert got[2][1] == 0 and got[3][1] == 13
