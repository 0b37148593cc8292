import time

import numpy as np
import pytest

from millrace.llm import boosting, language, language_model, toxicity


def test_trees_and_calibration():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0.3) & (x[:, 1] < 0.5)).astype(float)
    model = boosting.fit_boosted(x, y)
    assert ((model.raw(x) > 0) == y).mean() > 0.98
    chance = boosting.fit_isotonic(np.array([1.0, 2, 2, 3, 4]), np.array([0.0, 1, 0, 0, 1]))
    assert list(np.argsort(chance(np.array([1.0, 2, 3, 4])), kind="stable")) == [0, 1, 2, 3]
    same = boosting.fit_boosted(np.ones((5, 2)), np.ones(5))
    assert (same.raw(np.ones((2, 2))) > 5).all()


def test_calibration_uses_scores_of_unseen_rows():
    rng = np.random.default_rng(5)
    for n in (40, 3000):  # labels that nothing explains: trees know their own rows by heart, unseen rows they do not
        x, y = rng.normal(size=(n, 5)), (rng.random(n) < 0.3).astype(float)
        raw = boosting.unseen_raw(x, y, 4)
        own = boosting.fit_boosted(x, y).raw(x)
        gap = lambda r: r[y > 0].mean() - r[y == 0].mean()
        assert abs(gap(raw)) < gap(own) / 2
    assert boosting.unseen_raw(np.ones((1, 3)), np.ones(1), 4).tolist() == [0.0]
    assert len(boosting.unseen_raw(np.ones((2, 3)), np.array([0.0, 1.0]), 4)) == 2


def test_toxic_features():
    lexicon = toxicity.Lexicon({b"zog ": 2.0, b"blar": 1.5})
    row = dict(zip(toxicity.FEATURES, toxicity.features("YOU are an IDIOT! a zog, blargh and zogs", lexicon), strict=True))
    assert (row["insults"], row["near_you"], row["learned"], row["learned_most"]) == (1, 1, 2, 2.0)
    hidden = dict(zip(toxicity.FEATURES, toxicity.features("such an 1d10t and s-t-u-p-i-d", lexicon), strict=True))
    assert hidden["hidden"] == 2 and hidden["inside"] > 0
    assert toxicity.features(None, lexicon) == toxicity.features("", lexicon)


def test_toxicity_on_held_out_rows(spark):
    clean = [(i, f"a plain text about thing{i % 17} and place{i % 13}") for i in range(600)]
    bad = [(1000 + i, f"a plain text, {w} thing{i % 17}, you {w}") for i in range(200) for w in (["moron", "grulbix"][i % 2],)]
    docs = spark.createDataFrame(clean + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 1000)) for i, _ in clean + bad], "doc_id long, toxic int")
    out = toxicity.score(docs, toxicity.train(docs, labels)).toPandas()
    assert ((out["predicted"] == 1) == (out["doc_id"] >= 1000)).mean() > 0.98 and out["score"].between(0, 1).all()


def test_toxicity_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (6, None), (None, 1), (9, 0), (8, 1)], "doc_id long, toxic int")
    for model in (toxicity.train(odd, labels), toxicity.train(odd, labels.limit(0)), toxicity.train(none, labels)):
        out = toxicity.score(odd, model)
        rows = out.collect()
        assert len(rows) == 12 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
        assert len({r["score"] for r in rows if not (r["text"] or "")}) == 1 and out.columns.count("score") == 1
    assert toxicity.score(none, toxicity.train(none, labels)).count() == 0


@pytest.fixture(scope="module")
def spoken(spark):
    lines = {
        "en": "the house and the tree were in this town when that man with the dog went there",
        "de": "das haus und der baum waren in der stadt als dieser mann mit dem hund dorthin ging",
        "fr": "la maison et les arbres de cette ville quand un homme avec le chien est parti là",
        "es": "la casa y los árboles de esta ciudad cuando el hombre con su perro se fue allí",
        "xx": "zzyx qwop zzyx plugh xyzzy qwop frotz plugh zzyx gnusto rezrov qwop",
    }
    rng, rows = np.random.default_rng(1), []
    for i in range(500):
        lang = list(lines)[i % 5]
        rows.append((i, " ".join(rng.choice(lines[lang].split(), 12)), lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages_on_held_out_rows(spoken):
    model = language.train(spoken, per_language=60)
    assert set(model.families) == {"germanic", "romance", "xx"} and set(model.duels) == {("de", "en"), ("es", "fr")}
    out = language.identify(spoken, model).toPandas()
    held = out[out["doc_id"].map(lambda i: __import__("zlib").crc32(str(i).encode()) % 3 == 1)]
    assert (held["lang"] == held["lang_pred"]).mean() > 0.95 and out["score"].between(0, 1).all()


def test_languages_of_odd_rows(odd, none, spoken):
    for model in (language.train(odd), language.train(none), language.train(spoken, 20)):
        rows = {(r["doc_id"], r["text"]): r for r in language.identify(odd, model).collect()}
        for text in (None, "", " \t\n", "12345 !!! ???"):
            assert all(r["lang_pred"] == "und" for k, r in rows.items() if k[1] == text)
        known = {r["lang_pred"] for r in rows.values()}
        assert known == {"und"} if model is None else known - {"und"}
    assert language.identify(none, None).count() == 0


SMALL = language_model.Shape(own=5, shared=4, dim=4, context=2, head=12, noise=8, batches=(32,) * 4)


def test_token_probabilities_sum_to_one(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").limit(20)
    counts = language_model.token_counts(docs)
    known = language_model.vocabulary(counts, SMALL)
    p = language_model.train(docs, known, SMALL)
    classes = known.own + 1 + known.shared
    before = np.array([[1, 2]] * classes)
    of_class = 10 ** language_model.class_log10(p, before, np.arange(classes))
    assert of_class.sum() == pytest.approx(1, abs=1e-5)
    inside = np.zeros(classes)
    inside[: known.own + 1] = 1
    own = {bytes(w) for w in known.head[: known.own + 1]}
    for r in counts.collect():
        if bytes(r["word"]) not in own:
            at = language_model.shared_class(bytes(r["word"]), known.shared)
            inside[known.own + 1 + at] += (r["c"] + 1) / known.shared_total[at]
    inside[known.own + 1 :] += 1 / known.shared_total  # words never seen
    assert inside == pytest.approx(np.ones(classes))


def test_scores(spark, data):
    import zlib
    from collections import Counter

    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    rows = {r["doc_id"]: r for r in language_model.score(docs, SMALL).collect()}
    counts = Counter()
    for r in docs.collect():
        if zlib.crc32(str(r["doc_id"]).encode()) % 7 != 2:
            counts.update([*(r["text"] or "").encode().lower().split(), b""])
    n, v = sum(counts.values()), len(counts)
    for r in docs.collect():
        tokens, got = [*(r["text"] or "").encode().lower().split(), b""], rows[r["doc_id"]]
        assert (got["n_tokens"], got["n_known"], got["train_tokens"]) == (len(tokens), sum(counts[t] > 0 for t in tokens), n)
        assert got["base_score"] == pytest.approx(sum(np.log10((counts[t] + 1) / (n + v + 1)) for t in tokens))
    # which words have a number of their own in the head is a matter of speed, not of the score
    wide = language_model.Shape(**{**SMALL.__dict__, "head": 5000})
    again = {r["doc_id"]: r for r in language_model.score(docs, wide).collect()}
    assert all(again[i]["score"] == pytest.approx(rows[i]["score"], rel=1e-3) for i in rows)


def plain_step(p, scale, shape, log_noise, before, target, noise):
    """A step of noise-contrastive estimation with Adagrad, by the book, in double precision."""
    n, seen = len(target), [p["seen"][before[:, k]] for k in range(shape.context)]
    said = sum(s @ t for s, t in zip(seen, p["turn"], strict=True))
    right, wrong = p["next"][target], p["next"][noise]
    g_true = (1 / (1 + np.exp(-((said * right).sum(1) + p["bias"][target] - log_noise[target]))) - 1) / n
    g_false = 1 / (1 + np.exp(-(said @ wrong.T + p["bias"][noise] - log_noise[noise]))) / n
    g_said = g_true[:, None] * right + g_false @ wrong
    g = {k: np.zeros(v.shape) for k, v in p.items()}
    for name, of_target, of_noise in (("next", g_true[:, None] * said, g_false.T @ said), ("bias", g_true, g_false.sum(0))):
        np.add.at(g[name], target, of_target)
        np.add.at(g[name], noise, of_noise)
    for k in range(shape.context):
        g["turn"][k] = seen[k].T @ g_said
        np.add.at(g["seen"], before[:, k], g_said @ p["turn"][k].T)
    for name in p:
        scale[name] += g[name] ** 2
        p[name] -= shape.rate * g[name] / np.sqrt(scale[name])


def test_training_is_the_plain_one_and_products_stay_in_one_thread():
    shape, rng = language_model.Shape(), np.random.default_rng(5)
    k = shape.classes
    shares = rng.random(k) ** 4 + 1e-4
    shares /= shares.sum()
    p = {
        "seen": rng.normal(0, 0.1, (k, shape.dim)), "turn": np.stack([np.eye(shape.dim)] * shape.context) / shape.context,
        "next": rng.normal(0, 0.1, (k, shape.dim)), "bias": np.log(shares),
    }
    drawn = rng.choice(k, 1300 + shape.context, p=shares)
    before, target, _ = language_model.contexts([drawn], 0, shape.context)
    trainer = language_model.Trainer({n: v.astype(np.float32) for n, v in p.items()}, shares, shape, 7)
    trainer.learn(before, target, 256)
    noise, scale = np.random.default_rng(7), {n: np.full(v.shape, 0.1) for n, v in p.items()}
    for at in range(0, len(target), 256):  # the last step is a short one
        of_step = np.searchsorted(np.cumsum(shares), noise.random(shape.noise))
        plain_step(p, scale, shape, np.log(shape.noise * shares), before[at : at + 256], target[at : at + 256], of_step)
    assert all(np.abs(trainer.p[n] - p[n]).max() < 1e-5 for n in p) and trainer.tokens == len(target)

    before, target = np.tile(before, (100, 1)), np.tile(target, 100)
    score = sum(p["seen"][before[:, i]] @ p["turn"][i] for i in range(shape.context)) @ p["next"].T + p["bias"]
    want = (score[np.arange(len(target)), target] - np.log(np.exp(score).sum(1))) / np.log(10)
    wall, cpu = time.perf_counter(), time.process_time()
    got = language_model.class_log10(trainer.p, before, target)
    wall, cpu = time.perf_counter() - wall, time.process_time() - cpu
    assert np.abs(got - want).max() < 1e-4 and cpu < 1.4 * wall + 0.05


def test_model_beats_counts_on_held_out_texts(spark):
    rng, rows = np.random.default_rng(3), []
    groups = [[f"{c}{k}" for k in range(40)] for c in "abcd"]
    for i in range(600):
        rows.append((i, " ".join(rng.choice(groups[i % 4], 40))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    shape = language_model.Shape(own=100, shared=20, dim=8, context=3, batches=(64,) * 4)
    out = language_model.score(docs, shape).where("held_out").toPandas()
    assert (out["score"] > out["base_score"]).mean() > 0.95


def test_default_shape_learns_from_context(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(4)
    sums = language_model.score(docs).where("held_out").selectExpr("sum(score) / sum(n_tokens) AS score", "sum(base_score) / sum(n_tokens) AS base").first()
    assert sums["score"] - sums["base"] > 0.01  # per token; 0.001 with larger steps and half the noise


def test_scores_of_odd_rows(odd, none):
    rows = language_model.score(odd, SMALL).collect()
    assert len(rows) == 12
    empty = [r for r in rows if r["doc_id"] in (3, 4, 5)]
    assert len(empty) == 3 and len({(r["n_tokens"], r["base_score"], r["score"]) for r in empty}) == 1
    twins = [r for r in rows if r["doc_id"] == 2]
    assert len(twins) == 2 and twins[0] == twins[1]
    assert language_model.score(none, SMALL).count() == 0


def test_letters_are_those_of_category_l():
    assert not any(map(language.has_letter, (None, "", "½ ²", "Ⅷ ①", "12 _ %", "́")))
    assert all(map(language.has_letter, ("a", "½ ñ", "ª", "ǅ", "日", "ʰ")))
