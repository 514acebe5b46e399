"""Corpus operators on small tables against brute force, and at the edges of their input."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillpoint.llm import chat_format, decontamination, language_id, mixing, ngram_join, sharding, token_counts, toxicity
from tillpoint.llm.components import connected_components
from tillpoint.llm.substring_dedup import paragraphs, repeated_passages, set_sizes
from tillpoint.llm.textops import WordHasher
from tillpoint.llm.vector_dedup import near_vectors

WORD = re.compile(r"[^\x20\x09-\x0d]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, len(t) if t else 0) for i, t, lang, source in rows], SCHEMA)


def sentences(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" + ("." if k % 9 == 8 else "") for k in range(n))


def edges(rng):
    """Nulls, empty and blank texts, a very long one, repeated rows, a null id, copies."""
    base = sentences(rng, 120, 5000)
    near = base.split()
    near[60] = "changed"
    return [
        (1, None, None, None), (2, "", "en", "a"), (3, "  \n\t ", "en", "a"), (4, "one two", None, "a"),
        (5, "One  TWO", "en", None), (6, base, "en", "a"), (7, " ".join(near), "en", "b"), (8, base.upper(), "en", "b"),
        (9, sentences(rng, 30_000, 9000), "en", "a"), (6, base, "en", "a"), (None, base, "en", "a"), (None, None, None, None),
    ]


def brute_components(rows):
    sets = []
    for _, t, *_ in rows:
        w = WORD.findall(t.translate(LOWER)) if t else []
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for (a, x), (b, y) in itertools.combinations(enumerate(sets), 2):
        ids = rows[a][0], rows[b][0]
        if None in ids:
            continue
        if ids[0] == ids[1] or x and y and 4 * len(x & y) >= 3 * len(x | y):
            p, q = sorted((find(ids[0]), find(ids[1])))
            top[q] = p
    return sorted(((i, len(s), None if i is None else find(i)) for (i, *_), s in zip(rows, sets, strict=True)), key=str)


def mutated(rng, words, share):
    return " ".join(f"m{rng.randrange(10**6)}" if rng.random() < share else w for w in words)


def test_jaccard_components_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LONG_LIST", 6)  # so that blocks are met as well
    rng = random.Random(5)
    rows = edges(rng)
    for family in range(3):
        words = sentences(rng, rng.choice([12, 80, 200]), 6000).split()
        rows += [(100 * (family + 1) + k, mutated(rng, words, rng.choice([0, 0.01, 0.03, 0.06])), "en", "a") for k in range(14)]
    shared = sentences(rng, 40, 6000)
    rows += [(900 + k, f"{shared} {sentences(rng, 60, 6000)}", "en", "a") for k in range(12)]
    got = ngram_join.jaccard_components(frame(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_components(rows)


def test_long_posting_lists_pass_through_in_batches():
    rng = random.Random(13)
    rows = [(5, s) for s in range(1000)] + [(t, rng.randrange(4)) for t in range(6, 40) for _ in range(rng.randrange(1, 5))]
    rows += [(50, s) for s in range(6)] + [(51, 1), (52, 1), (52, 1), (53, 1), (53, 2)]
    rows = sorted(rows + rows[::3])
    for size in (1, 7, 50, 5000):
        taken = []

        def batches(size=size, taken=taken):
            for k in range(0, len(rows), size):
                taken.append(k)
                yield pd.DataFrame(rows[k : k + size], columns=["token", "sig"]).assign(n=9)

        got = []
        for part in ngram_join.tagged_lists(batches(), 6):
            assert len(part) <= size + 5
            got += part[["token", "sig", "long"]].itertuples(index=False, name=None)
            assert len(got) + size + 5 >= len({r for r in rows[: taken[-1] + size] if r[0] == 5})
        held = {t: len({s for u, s in rows if u == t}) for t, _ in rows}
        assert got == [(t, s, held[t] >= 6) for t, s in sorted(set(rows)) if held[t] > 1]


def test_components_of_paths_and_hubs(spark):
    pairs = [(k, k + 1) for k in range(1, 40)] + [(1000, 2000 + k) for k in range(50)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {k: 1 for k in range(1, 41)} | {1000: 1000} | {2000 + k: 1000 for k in range(50)}


def test_repeated_passages_are_found_wherever_they_stand(spark):
    rng = random.Random(8)
    passage = " ".join(f"p{k}{rng.randrange(99)}" + ("." if k % 12 == 11 else "") for k in range(60))
    changed = passage.replace("p30", "q30")
    rows = edges(rng) + [(20 + k, sentences(rng, 50, 10**6) + " " + passage + " " + sentences(rng, 30, 10**6), "en", "a") for k in range(3)]
    rows += [(30, "Start " + changed + "\nend", "en", "a")] + [(40 + k, sentences(rng, 90, 10**7), "en", "a") for k in range(5)]
    rows += [(50, "same line of just about nine words right here\n" * 4, "en", "a")]
    got = repeated_passages(frame(spark, rows)).collect()
    text = {i: t for i, t, *_ in rows}
    assert {r["doc_id"] for r in got} == {6, 7, 8, 20, 21, 22, 30}
    for r in got:
        assert r["n_words"] == len(text[r["doc_id"]][r["start"] : r["end"]].split())
    kept = [r["class_id"] for r in got if r["kept"]]
    assert sorted(set(kept)) == sorted({r["class_id"] for r in got})
    assert repeated_passages(frame(spark, [])).count() == 0


def test_passages_of_short_sentences_and_lines_have_no_holes(spark):
    rng = random.Random(12)
    words = [f"p{k}" for k in range(60)]
    six = [" ".join(words[k : k + 6]) for k in range(0, 60, 6)]
    passages = [". ".join(six) + ".", "\n".join(six), "\n".join(" ".join(words[k : k + 3]) for k in range(0, 60, 3))]
    for passage in passages:
        rows = [(k, f"{sentences(rng, 20 + k, 10**7)}.\n{passage}\n{sentences(rng, 30, 10**7)}", "en", "a") for k in range(3)]
        got = repeated_passages(frame(spark, rows)).collect()
        for i, text, *_ in rows:
            begin = text.index("p0")
            found = {c for r in got if r["doc_id"] == i for c in range(r["start"], r["end"])}
            missed = [m[0] for m in WORD.finditer(text) if m.start() >= begin and m[0][0] == "p" and m.start() not in found]
            assert len(missed) <= (1 if passage is passages[2] else 0), missed  # a short last line goes with what follows
            assert all(text[r["start"] : r["end"]].split()[0][0] == "p" for r in got if r["doc_id"] == i)
    hasher = WordHasher()
    for _ in range(200):
        text = "".join(f"w{rng.randrange(9)}" + rng.choice([" ", " ", ". ", "\n", "! "]) for _ in range(rng.randrange(5, 40)))
        p = paragraphs(text, hasher)
        covered = {c for a, b in zip(p.start.tolist(), p.end.tolist(), strict=True) for c in range(a, b)}
        assert all(m.start() in covered for m in WORD.finditer(text)) and min(p.words) >= 5
        assert len({*zip(p.start.tolist(), p.end.tolist(), strict=True)}) == len(p.start)


def test_paragraphs_link_by_their_different_shingles(spark):
    phrase = "round and round the garden like a teddy bear went he "  # eleven shingles, however often
    rows = [(1, phrase * 2 + "round and round the", "en", "a"), (2, phrase * 4 + "round and round the", "en", "a")]
    got = repeated_passages(frame(spark, rows)).collect()
    assert {(r["doc_id"], r["kept"]) for r in got} == {(1, True), (2, False)} and len({r["class_id"] for r in got}) == 1
    rng, hasher = random.Random(14), WordHasher()
    for _ in range(100):
        p = paragraphs("".join(rng.choice("ab") + rng.choice([" ", " ", " ", ". ", "\n"]) for _ in range(80)), hasher)
        assert set_sizes(p).tolist() == [len({*p.shingle[a:b].tolist()}) for a, b in zip(p.first, p.last, strict=True)]


def test_byte_shards_are_gapless_and_even(spark):
    rng = random.Random(2)
    rows = edges(rng)[:8] + [(100 + k, sentences(rng, rng.randrange(1, 200)), "en", "a") for k in range(300)]
    got = sharding.shard_report(frame(spark, rows), 7).collect()
    size = {i: len((t or "").encode()) + 16 for i, t, *_ in rows}
    assert len(got) == len(rows) and all(r["size"] == size[r["doc_id"]] for r in got)
    assert all(r["text_crc32"] == zlib.crc32(({i: t for i, t, *_ in rows}[r["doc_id"]] or "").encode()) for r in got)
    total, before = sum(r["size"] for r in got), 0
    for r in sorted(got, key=lambda r: (r["shard"], r["slot"])):
        assert r["shard"] == min(6, (2 * before + r["size"]) * 7 // (2 * total))
        before += r["size"]
    for shard in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in got)))
    assert len(sharding.shard_report(frame(spark, edges(rng)), 3).collect()) == 12
    assert sharding.shard_report(frame(spark, []), 3).count() == 0


def test_language_of_held_out_texts(spark):
    rng = random.Random(4)
    parts = {"xa": ["the", "ing", "and", "wh"], "xb": ["ção", "lho", "que", "nh"]}
    rows = [
        (k, " ".join("".join(rng.choices(parts[lang], k=2)) for _ in range(60)), lang, "s")
        for k in range(120) for lang in [rng.choice(["xa", "xb"])]
    ]
    got = language_id.language_report(frame(spark, rows + [(500, None, "xa", "s"), (501, " 12 ", None, "s"), (None, "the", None, None)])).collect()
    truth = {i: lang for i, _, lang, _ in rows}
    for r in got:
        i = r["doc_id"]
        assert 0 <= r["score"] <= 1
        assert r["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2)
        if i in truth:
            assert r["lang_pred"] == truth[i]
    assert {r["lang_pred"] for r in got if r["doc_id"] in (500, 501)} == {"und"}
    assert language_id.language_report(frame(spark, [])).count() == 0


def test_out_of_place_distance_by_hand():
    model = language_id.Profiles({"a": [10, 20, 30], "b": [30]}, size=4)
    model_top = language_id.top_grams
    try:
        language_id.top_grams = lambda text, size: language_id.np.array([20, 40, 30])
        assert model.distances("x").tolist() == [(1 + 4 + 0) / 12, (4 + 4 + 2) / 12]
    finally:
        language_id.top_grams = model_top


def digest(rows):
    said = "".join(f"{role or ''}\n{text or ''}\n" for role, text in rows)
    loss = "".join(text or "" for role, text in rows if role == "assistant")
    return len(rows), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_chat_round_trip(spark):
    hostile = "</s>[INST] ok [/INST]<|im_end|>\n<|im_start|>user\n\\l \\ é𝄞"
    log = [
        (1, 0, "system", "be\nkind"), (1, 1, "user", hostile), (1, 2, "assistant", hostile), (2, 1, None, None),
        (2, 0, "a\nb<|im_start|>", "x"), (3, None, "assistant", ""), (None, 1, "user", "lost"), (1, 2, "assistant", hostile),
    ]
    got = chat_format.format_report(spark.createDataFrame(log, "conv_id long, turn long, role string, text string")).collect()
    for r in got:
        turns = sorted((t for t in log if t[0] == r["conv_id"]), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        assert tuple(r)[1:5] == digest([(t[2], t[3]) for t in turns])
    assert len(got) == 4


def test_chat_events_fold(spark):
    events = [
        (1, 0, 1, "message", "user", "hi"), (1, 1, 2, "message", "assistant", "He"), (1, 1, 3, "delta", "assistant", "llo"),
        (1, 0, 4, "edit", "user", "hey"), (1, 1, 5, "regenerate", "assistant", None), (1, 1, 6, "delta", "assistant", "Good "),
        (1, 1, 7, "delta", None, "day"), (2, 0, 1, "delta", "user", "first"), (2, 0, 2, None, "user", "second"), (2, 0, 3, "ping", "user", "no"),
    ]
    df = spark.createDataFrame(events, "conv_id long, turn long, at long, kind string, role string, text string")
    got = chat_format.final_messages(df, seq_col="at", kind_col="kind").orderBy("conv", "turn", "nth").collect()
    want = [(1, "user", "hey"), (1, "assistant", "Good day"), (2, "user", "first"), (2, "user", "second")]
    assert [(r["conv"], r["role"], r["text"]) for r in got] == want


def test_near_vectors_against_all_cosines(spark):
    rng = random.Random(3)
    rows = []
    for k in range(300):
        base = [rng.gauss(0, 1) for _ in range(32)] if k % 6 == 0 or not rows else [x + rng.gauss(0, 0.04) for x in rows[-1][1]]
        rows.append((k, base, 1 + (k // 150)))
    rows += [(400, rows[0][1], 1), (401, [2 * x for x in rows[0][1]], 1), (402, rows[0][1], 2)]
    odd = [(500, None, 1), (501, [0.0] * 32, 1), (502, [float("nan")] * 32, 1), (503, rows[0][1], None), (504, [], 1), (505, [None, 1.0], 1), (506, [1.0, 1.0], 1)]
    df = spark.createDataFrame(rows + odd + [(None, rows[0][1], 1)], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r for r in near_vectors(df).collect()}
    unit = {i: ([x / math.hypot(*v) for x in v], label) for i, v, label in rows}
    links = {i: set() for i in unit}
    for i, j in itertools.combinations(unit, 2):
        if unit[i][1] == unit[j][1] and sum(a * b for a, b in zip(unit[i][0], unit[j][0], strict=True)) >= 0.98:
            links[i].add(j)
            links[j].add(i)
    assert sum(got[i]["n_links"] for i in unit) >= 0.97 * sum(map(len, links.values()))
    assert all(got[i]["n_links"] <= len(links[i]) for i in unit) and got[400]["n_links"] >= 2
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i, *_ in odd)
    assert not got[None]["kept"] and got[None]["n_links"] == 0


@pytest.mark.parametrize("written,meant", [("1d10t", "idiot"), ("s t u p i d", "stupid"), ("s.t.u.p.i.d", "stupid"), ("stuuuupid", "stupid"), ("tr4$h", "trash"), ("a$$", "ass"), ("sh!+", "shit"), ("iiddiioott", "idiot"), ("s  t  u  p  i  d", "stupid")])
def test_obfuscated_words_are_restored(written, meant):
    rng = random.Random(1)
    words = ["idiot", "stupid", "trash", "shit", "ass", "the", "good", "people", "tree", "is", "all"]
    model = toxicity.CharacterModel(toxicity.trigram_counts([" ".join(rng.choices(words, k=4000))]))
    assert toxicity.Restorer(model)(f"the {written} is good") == f"the {meant} is good"
    assert toxicity.Restorer(model)("the good tree is 42, all!") == "the good tree is 42, all!"
    assert toxicity.Restorer(model)("bookkeeper") == "bookkeeper" and toxicity.Restorer(model)("a b") == "a b"


def test_training_texts_are_bounded_by_rows(spark):
    rows = [(1, f"vile text number {k}", "en", "a") for k in range(500)] + [(k, f"fine text number {k}", "en", "a") for k in range(2, 40)]
    marks = spark.createDataFrame([(k, int(k == 1)) for k in range(1, 40)], "doc_id long, toxic int")
    model = toxicity.learn_toxicity(frame(spark, rows), marks, rows=20)
    assert len(model.bucket) == 0  # one text of id 1 teaches, and a feature needs three toxic texts


def test_viterbi_finds_the_best_path():
    rng = random.Random(6)
    model = toxicity.CharacterModel(toxicity.trigram_counts(["all is trash and idiots lie"] * 50))
    table = toxicity.Symbols.table()

    def cost(text):
        s = [0, 0, *(int(table[ord(c)]) for c in text), 0]
        return sum(model.log[a][b][c] for a, b, c in zip(s, s[1:], s[2:], strict=False))

    for _ in range(40):
        token = "".join(rng.choice("a1l!3$tr7hs") for _ in range(6))
        paths = itertools.product(*model.lattice(token))
        best = max(cost("".join(t for t, _ in p)) + sum(w for _, w in p) for p in paths)
        got = model.decode(token)
        reach = max(sum(w for _, w in p) for p in itertools.product(*model.lattice(token)) if "".join(t for t, _ in p) == got)
        assert math.isclose(cost(got) + reach, best, abs_tol=1e-9)


def test_toxicity_is_learned_and_edges_are_scored(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for k in range(240):
        bad = k % 4 == 0
        text = sentences(rng, 40) + (" vilest" if bad else "") + " " + sentences(rng, 10)
        rows.append((k, text.replace("vilest", "v1le5t") if k % 8 == 0 else text, "en", "a"))
        labels.append((k, 1, int(bad)))
    docs = frame(spark, rows + [(900, None, None, None), (901, "", None, None), (None, "vilest", None, None), (3, rows[3][1], "en", "a")])
    marks = spark.createDataFrame(labels + [(None, 1, 1), (5, None, None), (999, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity_report(docs, marks).collect()
    assert len(got) == 244 and all(0 <= r["score"] <= 1 for r in got)
    unseen = [r for r in got if r["held_out"]]
    assert unseen and all(r["predicted"] == (r["doc_id"] % 4 == 0) for r in unseen if r["doc_id"] < 900)
    none = toxicity.toxicity_report(docs, marks.limit(0)).collect()
    assert {r["predicted"] for r in none} == {0}
    assert toxicity.toxicity_report(frame(spark, []), marks).count() == 0


def test_mixture_weights_repeats_and_budget(spark):
    rows = [(k, sentences(random.Random(k), 10), "en", "big") for k in range(900)]
    rows += [(1000 + k, sentences(random.Random(k), 10), "en", "small") for k in range(100)] + [(2000, "x y", None, None), (2001, None, None, "void")]
    df = frame(spark, rows).withColumn("weight", F.lit("clash"))
    got = mixing.mix_sources(df, max_repeats=2.5).collect()
    per = {}
    for r in got:
        per.setdefault(r["doc_id"], set()).add(r["epoch"])
        assert 0 <= r["mix_pos"] < 1
    assert set(per) == {i for i, *_ in rows} and all(e == set(range(len(e))) for e in per.values())
    tokens = {"big": 9000, "small": 1000, None: 2}
    small = sum(r["n_tokens"] for r in got if r["source"] == "small")
    plan = mixing.plan_mixture([(s, n) for s, n in tokens.items()] + [("void", 0)], max_repeats=2.5)
    want = next(p for p in plan if p.source == "small")
    assert math.isclose(sum(p.weight for p in plan), 1) and max(p.repeats for p in plan) <= 2.5 + 1e-6
    assert want.repeats * 1000 - 10 <= small <= want.repeats * 1000 + 1
    flat = mixing.plan_mixture([("a", 900), ("b", 90), ("c", 10)], target_entropy=0.9)
    assert math.isclose(mixing.entropy([p.weight for p in flat]), 0.9 * math.log(3), rel_tol=1e-6)
    limited = mixing.mix_sources(frame(spark, rows), budget=5000).collect()
    assert 4900 <= sum(r["n_tokens"] for r in limited) <= 5010
    assert mixing.mix_sources(frame(spark, []), max_repeats=2.0).count() == 0


def test_budget_ends_among_equal_rows(spark):
    text = "a b c d e f g h i j"
    rows = [(1, text, "en", "s")] * 500 + [(10 + k, sentences(random.Random(k), 10), "en", "s") for k in range(500)]
    for budget in (5000, 7500, 9990, 10000, 12345):
        got = mixing.mix_sources(frame(spark, rows), budget=budget).collect()
        assert budget - 10 < sum(r["n_tokens"] for r in got) <= budget
        shown = {}
        for r in got:
            shown[r["doc_id"]] = shown.get(r["doc_id"], 0) + 1
        least = budget // 10000  # whole permutations, then at most one more of every row
        assert all(least * (500 if i == 1 else 1) <= n <= (least + 1) * (500 if i == 1 else 1) for i, n in shown.items())
    apart = frame(spark, rows).withColumn("further", F.monotonically_increasing_id())  # equal ids and texts, different rows
    got = mixing.mix_sources(apart, budget=5000).collect()
    assert len({r["further"] for r in got}) == len(got) == 500


def brute_mixture(rows, exponent_grid, max_repeats):
    """Repeats of each source at the least exponent of a fine grid that keeps to ``max_repeats``."""
    tokens = {}
    for _, text, _, source in rows:
        tokens[source] = tokens.get(source, 0) + len((text or "").split())
    for k in range(exponent_grid + 1):
        raised = {s: n ** (k / exponent_grid) for s, n in tokens.items() if n}
        weight = {s: x / sum(raised.values()) for s, x in raised.items()}
        budget = max(tokens[s] / w for s, w in weight.items())
        repeats = {s: budget * w / tokens[s] for s, w in weight.items()}
        if max(repeats.values()) <= max_repeats:
            return tokens, repeats
    return tokens, dict.fromkeys(tokens, 1.0)


@pytest.mark.parametrize("most", [20_000, 3])
def test_mixture_equals_brute_force(spark, most):
    rng = random.Random(5)
    rows = [(k, sentences(rng, rng.randrange(1, 30)), "en", f"s{min(int(rng.expovariate(0.4)), 9)}") for k in range(1500)]
    rows += [(9000, None, None, "void"), (9001, "x y z", None, None)]
    tokens, repeats = brute_mixture(rows, 20_000, 2.0)
    got = mixing.mix_sources(frame(spark, rows), max_repeats=2.0, broadcast_sources=most).collect()
    shown, ids = {}, {}
    for r in got:
        shown[r["source"]] = shown.get(r["source"], 0) + r["n_tokens"]
        ids.setdefault(r["doc_id"], []).append(r["epoch"])
    assert set(ids) == {r[0] for r in rows} and all(sorted(e) == list(range(len(e))) for e in ids.values())
    for source, n in tokens.items():
        want = repeats.get(source, 1.0) * n
        assert want - 31 - n / 1000 <= shown[source] <= want + 1 + n / 1000, source


def test_more_sources_than_are_broadcast(spark):
    rows = [(k, "one two three" if k % 7 else "one", "en", f"host{k % 3000}") for k in range(6000)]
    few = mixing.mix_sources(frame(spark, rows), target_entropy=0.9999, max_repeats=2.0)
    many = mixing.mix_sources(frame(spark, rows), target_entropy=0.9999, max_repeats=2.0, broadcast_sources=100)
    key = lambda r: (r["doc_id"], r["epoch"])
    for a, b in zip(sorted(few.collect(), key=key), sorted(many.collect(), key=key), strict=True):
        assert key(a) == key(b) and math.isclose(a["weight"], b["weight"], rel_tol=1e-9) and math.isclose(a["mix_pos"], b["mix_pos"], rel_tol=1e-9)


def brute_edits(item, text):
    row = [0] * (len(text) + 1)
    for c in item:
        new = [row[0] + 1]
        for j, d in enumerate(text):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_leaks_equal_full_edit_distance(spark):
    rng = random.Random(11)
    items = [(k, " ".join("".join(rng.choices("abcde", k=rng.randrange(2, 7))) for _ in range(12))) for k in range(6)]
    rows = []
    for k in range(60):
        t = list(rng.choice(items)[1])
        for _ in range(rng.randrange(0, 7)):
            at = rng.randrange(len(t))
            t[at : at + 1] = rng.choice([[], ["x"], [t[at], "y"]])
        rows.append((k, "Intro  text " + "".join(t).upper() + "\n tail", "en", "a"))
    rows += [(80, None, None, None), (81, "", None, None), (None, items[0][1], None, None), (82, sentences(rng, 20_000) + " " + items[2][1], "en", "a"), (82, sentences(rng, 5), "en", "a")]
    bench = spark.createDataFrame(items + [(90, None), (None, items[1][1]), (91, "too short"), (92, "")], "item_id long, text string")
    docs = frame(spark, rows)
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in decontamination.leak_report(docs, bench).collect()}
    want = {}
    for i, t, *_ in rows:
        if t and len(t) < 5000:
            for k, item in items:
                e = brute_edits(decontamination.normalise(item), decontamination.normalise(t))
                if e <= math.floor(len(decontamination.normalise(item)) * decontamination.MAX_ERROR):
                    want[i, k] = e
    want[82, 2] = 0
    assert got == want and len(want) > 20
    blocks = decontamination.mark_leaks(docs, bench, block_bytes=100)
    assert sum(len(r["leaks"]) for r in blocks.collect()) == len(want)
    assert decontamination.leak_report(docs, bench.limit(0)).count() == 0


def test_short_items_and_scripts_without_blanks_are_searched(spark):
    long = "光合作用是植物利用光能把二氧化碳和水转化为有机物并释放氧气的过程这是考试的第一题"
    items = [(1, long), (2, "Who  wrote Hamlet?"), (3, "東京"), (4, " \n "), (5, "Shakespeare, William"), (6, "x")]
    rows = [
        (1, "前文" + long[:20] + "了" + long[20:] + "后文", "zh", "a"), (2, "quiz: who wrote\nhamlet? hamlet, who wrote hamlet?", "en", "a"),
        (3, "昨日東京で", "ja", "a"), (4, "昨日京都で who wrote Othello?", "ja", "a"), (5, "by shakespeare, wiliam", "en", "a"), (6, None, None, None),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(tuple(r) for r in decontamination.leak_report(frame(spark, rows), bench).collect())
    assert got == [(1, 1, 1, 2, 3 + len(long)), (2, 2, 0, 6, 23), (3, 3, 0, 2, 4), (5, 5, 1, 3, 22)]


def test_short_items_are_not_found_inside_words(spark):
    items = [(1, "x"), (2, "cat"), (3, "京")]
    rows = [(1, "box of wax", "en", "a"), (2, "concatenate a cat", "en", "a"), (3, "東京都x", "ja", "a"), (4, "x, y", "en", "a"), (5, "category", "en", "a")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(tuple(r) for r in decontamination.leak_report(frame(spark, rows), bench).collect())
    assert got == [(2, 2, 0, 14, 17), (3, 1, 0, 3, 4), (3, 3, 0, 1, 2), (4, 1, 0, 0, 1)]


def test_blocks_of_items_give_the_marks_of_one_search(spark):
    rng = random.Random(3)
    items = [(k // 2, sentences(rng, 12)) for k in range(30)]  # two texts for each id
    rows = [(k, sentences(rng, 20) + " " + rng.choice(items)[1] + " " + items[k % 30][1][1:], "en", "a") for k in range(50)]
    rows += [(7, rows[7][1], "de", "b"), (None, rows[8][1], None, None), (90, None, None, None), (91, "", None, None)]
    docs = frame(spark, rows).withColumn("a.b", F.col("doc_id")).withColumn("_text", F.lit("own")).withColumn("leaks", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string")
    one = decontamination.mark_leaks(docs, bench)
    many = decontamination.mark_leaks(docs, bench, block_bytes=300)
    assert many.columns == one.columns and many.schema["leaks"].dataType.simpleString() == one.schema["leaks"].dataType.simpleString()
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))
    assert one.where(F.size("leaks") > 0).count() >= 50
    decontamination._SEARCHES.clear()
    for name in ("one", "two", "two"):
        decontamination.searches_of(name, items, 0.05)
    assert list(decontamination._SEARCHES) == ["two"]  # a worker holds one block's search


def test_prefix_token_counts_are_exact(spark):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(token_counts.default_vocabulary())
    counter = token_counts.PrefixCounter()
    rng = random.Random(7)
    parts = ["a", "the", " ", "  ", "\n", "'", "'ll", "'re", "é", "1", "##", "<|endoftext|>", "<|end", "tion", " th", "中", "²", "\x1c"]
    for _ in range(200):
        text, size = "".join(rng.choices(parts, k=rng.randrange(9))), 0
        counts = counter.prefixes(text)
        for k, c in enumerate(text):
            size += len(c.encode())
            assert counts[size - 1] == len(library.encode(text[: k + 1], add_special_tokens=False).ids), text[: k + 1]
    rows = edges(rng) + [(70, "say <|endoftext|> twice", "en", "a")]
    got = token_counts.token_limit_report(frame(spark, rows)).collect()
    text = [t or "" for _, t, *_ in rows]
    want = sorted((len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for t in text)
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in got) == want and any(r["over_limit"] for r in got)
    df = token_counts.prefix_token_counts(frame(spark, [(1, "one two three", None, None), (2, None, None, None)]))
    asked = df.select("doc_id", token_counts.tokens_at("prefix_tokens", 7).alias("n"), token_counts.bytes_within("prefix_tokens", 2).alias("b"))
    assert sorted(tuple(r) for r in asked.collect()) == [(1, 2, 7), (2, 0, 0)]
    text = "中文é a😀"  # characters of one to four bytes are never cut
    df = token_counts.prefix_token_counts(frame(spark, [(1, text, None, None)])).checkpoint()
    ends = {0: 0}
    for k in range(len(text)):
        ends[len(text[: k + 1].encode())] = len(library.encode(text[: k + 1], add_special_tokens=False).ids)
    for budget in range(12):
        want = max(size for size, n in ends.items() if n <= budget)
        assert df.select(token_counts.bytes_within("prefix_tokens", budget)).first()[0] == want, budget
    for size in range(len(text.encode()) + 2):
        want = ends[max(e for e in ends if e <= size)]
        assert df.select(token_counts.tokens_at("prefix_tokens", size)).first()[0] == want, size
