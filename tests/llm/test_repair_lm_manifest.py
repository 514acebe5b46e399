"""Conversation repair, language-model scores and the Merkle manifest against brute force and at edges."""

from __future__ import annotations

import hashlib
import heapq
import math
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.llm.test_text_operators import LOWER, WORD, edges, frame, sentences

from tillpoint.llm.context_tree import Spelling, context_tree_scores, language_model_report
from tillpoint.llm.merkle import build_manifest, fold, leaf_digest, manifest_report
from tillpoint.llm.textops import WordHasher
from tillpoint.llm.turn_repair import block_moves, chain, repair_conversations, repair_report

CLASHES = ("g", "idx", "n", "h", "id", "key", "val", "block", "kind", "leaf", "proof", "at", "score", "a.b")
WHITE = " \t\n\x0b\f\r"


def clashing(df):
    """``df`` with further columns that bear the operators' own names."""
    return df.withColumns({c: F.lit("x") for c in CLASHES})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- conversation repair ------------------------------------------------------------------------


def least_edits(roles, faults):
    """Cheapest cost and its ASCII-least audit by label setting over (row, state); states: 0 nothing,
    1 after system, 2 after user, 3 after assistant."""
    heap, done, best = [(0, "", 0, 0)], set(), None
    while heap:
        cost, audit, i, q = heapq.heappop(heap)
        if best and cost > best[0]:
            break
        if (i, q, audit) in done:
            continue
        done.add((i, q, audit))
        if i == len(roles) and q in (0, 3):
            best = min(best or (cost, audit), (cost, audit))
        want, after = ("a", 3) if q == 2 else ("u", 2)
        heapq.heappush(heap, (cost + 3, audit + "I", i, after))
        if i < len(roles):
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, q))
            if faults[i] not in "bd":
                more = 3 if faults[i] == "t" else 0
                same = roles[i] == want
                heapq.heappush(heap, (cost + more + (0 if same else 3), audit + ("K" if same else "R"), i + 1, after))
                if q == 0 and roles[i] == "s":
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, 1))
    return best


def least_edits_of_many(roles, faults):
    """The same for long conversations: the best (cost, audit) of every state, row by row."""
    far = (10**9, "")
    states = [(0, ""), far, far, far]
    for i in range(len(roles) + 1):
        for _ in range(3):
            user = min((states[q][0] + 3, states[q][1] + "I") for q in (0, 1, 3))
            assistant = (states[2][0] + 3, states[2][1] + "I")
            states = [states[0], states[1], min(states[2], user), min(states[3], assistant)]
        if i == len(roles):
            return min(states[0], states[3])
        new = [(c + 4, a + "D") for c, a in states]
        if faults[i] not in "bd":
            more = 3 if faults[i] == "t" else 0
            for q, (c, a) in enumerate(states):
                want, after = ("a", 3) if q == 2 else ("u", 2)
                same = roles[i] == want
                new[after] = min(new[after], (c + more + (0 if same else 3), a + ("K" if same else "R")))
            if roles[i] == "s":
                new[1] = min(new[1], (states[0][0] + more, states[0][1] + "K"))
        states = new
    return None


def test_blocks_chain_to_the_cheapest_and_least_audit():
    rng = random.Random(5)
    for _ in range(800):
        n = rng.randrange(0, 6)
        roles = "".join(rng.choice("suxuaua") for _ in range(n))
        faults = "".join(rng.choice("----bdt") for _ in range(n))
        size = rng.randrange(1, 7)
        cost, steps, missing = chain([block_moves(roles[i : i + size], faults[i : i + size]) for i in range(0, n, size)])
        assert (cost, "".join(a for _, a in steps) + "I" * len(missing)) == least_edits(roles, faults)
        assert least_edits_of_many(roles, faults) == least_edits(roles, faults)


def brute_repair(rows):
    """Expected row of one conversation from (turn, role, text) after damage."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults, seen = "", set()
    for _, role, text in rows:
        bare = text.rstrip(WHITE)
        faults += "b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "-"
        seen.add((role, text))
    roles = "".join(r[1][:1] if r[1][:1] in ("s", "u", "a") else "x" for r in rows)
    cost, audit = least_edits_of_many(roles, faults)
    lines, i, system = [], 0, False
    for letter in audit:
        if letter == "D":
            i += 1
            continue
        if letter == "K" and not lines and roles[i] == "s":
            system = True
        name = ("assistant", "user")[(len(lines) + 1 + system) % 2]
        if letter == "I":
            lines.append(f"{name}:")
        else:
            lines.append(f"{rows[i][1] if letter == 'K' else name}:{rows[i][2]}")
            i += 1
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(roles[k : k + 2] not in ("su", "ua", "au") for k in range(len(roles) - 1))
    return (gaps, *[faults.count(x) for x in "bdt"], illegal, cost, audit, sha("\n".join(lines)))


def hurt(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        luck = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if luck == 0:
            continue
        text = "" if luck == 1 else text.translate({ord(c): None for c in ".!?"}) if luck == 2 else text
        out += [(conv, turn, "user" if luck == 4 else role, text)] * (2 if luck == 3 else 1)
    return out


CONVERSATION = "conv_id long, turn long, role string, text string"


def test_repair_report_equals_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for conv in [*range(60), None, 2**53 + 1]:
        if rng.random() < 0.4:
            rows.append((conv, 0, "system", "Be kind."))
        for turn in range(1, rng.randrange(2, 8)):
            if rng.random() < 0.9:
                text = rng.choice(["Yes.", "No", "", " \t", None, "Why?", f"Turn {turn}!", f"Say {turn}"])
                rows.append((conv, turn, rng.choice(["user", "assistant", "assistant", "tool", None, ""]), text))
    rows += [(3, None, "user", "First."), (3, None, "user", "Again."), (5, 2, "user", "Same."), (5, 2, "user", "Same.")]
    df = clashing(spark.createDataFrame(rows, CONVERSATION).repartition(5))
    got = {r["conv_id"]: tuple(r)[1:] for r in repair_report(df).collect()}
    after = {conv: [] for conv, *_ in rows}
    for conv, *row in hurt(rows):
        after[conv].append(tuple(row))
    assert got == {conv: brute_repair(own) for conv, own in after.items()}
    assert repair_report(df).columns[:9] == "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


def test_long_conversation_and_lost_one(spark):
    rng = random.Random(2)
    long = [(1, t, ("user", "assistant")[t % 2], f"Line {t}." + "x" * (90_000 if t == 7 else 0) + ".") for t in range(400)]
    long = [(c, t, rng.choice(["user", "assistant"]) if rng.random() < 0.1 else r, x) for c, t, r, x in long if rng.random() < 0.9]
    lost = next(c for c in range(2, 999) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([*long, (lost, 0, "user", "Gone.")], CONVERSATION)
    got = {r["conv_id"]: tuple(r)[1:] for r in repair_report(df).collect()}
    assert got[1] == brute_repair([r[1:] for r in hurt(long)])
    assert got[lost] == (0, 0, 0, 0, 0, 0, "", sha(""))
    assert repair_report(df.limit(0)).collect() == []


def test_repaired_turns_keep_texts_and_alternate(spark):
    rows = [(7, 1, "system", "Rules."), (7, 2, "assistant", "Hello."), (7, 3, "user", "Hi"), (7, 4, "user", "Hm."), (8, 1, "user", " ")]
    made = repair_conversations(spark.createDataFrame(rows, CONVERSATION), "conv_id", "turn", "role", "text")
    turns = sorted(tuple(r) for r in made.turns.collect())
    assert [r[2] for r in turns] == ["system", "user", "assistant"] or [r[2] for r in turns][1::2] == ["user"] * (len(turns) // 2)
    audits = {r["g"]: (r["cost"], r["audit"]) for r in made.audits.collect()}
    assert audits["1:7"] == least_edits("sauu", "--t-") and audits["1:8"] == (4, "D")


# -- language model -----------------------------------------------------------------------------


def kt(counts):
    """Exact Krichevsky-Trofimov probability of a sequence with these counts of zeros and ones."""
    p, a, b = Fraction(1), 0, 0
    for _ in range(counts[0]):
        p *= Fraction(2 * a + 1, 2 * (a + b + 1))
        a += 1
    for _ in range(counts[1]):
        p *= Fraction(2 * b + 1, 2 * (a + b + 1))
        b += 1
    return p


class Tree:
    """Context trees in exact arithmetic, one for each place in the byte's binary tree."""

    def __init__(self, texts, depth):
        self.depth, self.counts, self.memo = depth, {}, {}
        self.children = {}
        for t in texts:
            for context, node, bit in self.decisions(t):
                for d in range(depth + 1):
                    self.counts.setdefault((context[:d], node), [0, 0])[bit] += 1
                    if d:
                        self.children.setdefault((context[: d - 1], node), set()).add(context[:d])

    def decisions(self, text):
        data = text.encode("utf-8", "surrogatepass")
        for i, byte in enumerate(data):
            context = tuple(data[i - j] if i >= j else 0 for j in range(1, self.depth + 1))
            for k in range(8):
                yield context, (1 << k) | (byte >> (8 - k)), (byte >> (7 - k)) & 1

    def weighted(self, context, node):
        if (context, node) not in self.memo:
            own, below = kt(self.counts[context, node]), Fraction(1)
            if len(context) < self.depth:
                for child in self.children[context, node]:
                    below *= self.weighted(child, node)[0]
                self.memo[context, node] = (own + below) / 2, own / (own + below)
            else:
                self.memo[context, node] = own, Fraction(1)
        return self.memo[context, node]

    def log10(self, text):
        total = 0.0
        for context, node, bit in self.decisions(text):
            p = Fraction(1, 2)
            for d in range(self.depth, -1, -1):
                if (context[:d], node) in self.counts:
                    a, b = self.counts[context[:d], node]
                    one = Fraction(2 * b + 1, 2 * (a + b + 1))
                    if d == self.depth or (context[: d + 1], node) not in self.counts:
                        p = one
                    else:
                        share = self.weighted(context[:d], node)[1]
                        p = share * one + (1 - share) * p
            total += math.log10(p if bit else 1 - p)
        return total


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def test_scores_equal_exact_tree_and_frequencies(spark):
    rng = random.Random(4)
    rows = [(i, sentences(rng, rng.randrange(0, 9), 12), "en", "a") for i in range(40)]
    rows += [(90, None, None, None), (91, "", "en", "a"), (92, " \t", "en", "a"), (93, "Ünï CASE x\x00y", "de", "b"), (None, "w1 w2", "en", "a")]
    rows += [(0, rows[0][1], "en", "a"), (94, "zebra quux zebra", "en", "a")]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    df = clashing(frame(spark, rows).repartition(3))
    unseen = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    got = sorted(context_tree_scores(df, ~unseen, depth=3).collect(), key=str)
    own = {i: " ".join(words_of(t)) + "\n" for i, t, *_ in rows}
    training = [" ".join(words_of(t)) + "\n" for i, t, *_ in rows if not held(i)]
    tree = Tree(training, 3)
    tokens = Counter(w for t in training for w in [*words_of(t), "\n"])
    n, kinds = sum(tokens.values()), len(tokens)
    assert len(got) == len(rows)
    for i, trains, n_tokens, n_known, train_tokens, base, score in got:
        said = [*words_of(own[i]), "\n"]
        assert (trains, n_tokens, n_known, train_tokens) == (not held(i), len(said), sum(tokens[w] > 0 for w in said), n)
        assert base == pytest.approx(sum(math.log10((tokens[w] + 0.5) / (n + 0.5 * (kinds + 1))) for w in said), rel=1e-9)
        assert score == pytest.approx(tree.log10(own[i]), rel=1e-7)


def test_model_beats_frequencies_on_unseen_texts_and_edges(spark):
    rng = random.Random(6)
    rows = edges(rng) + [(100 + k, " ".join(rng.choice(["the cat sat", "a dog ran far", "birds sing"]) for _ in range(30)), "en", "a") for k in range(120)]
    report = language_model_report(frame(spark, rows))
    assert report.columns == "doc_id held_out n_tokens n_known train_tokens base_score score".split()
    got = report.collect()
    assert len(got) == len(rows)
    unseen = [r for r in got if r["held_out"] and r["doc_id"] >= 100]
    assert unseen and all(r["score"] > r["base_score"] for r in unseen)
    assert all(r["n_tokens"] == 1 and r["n_known"] == 1 for r in got if r["doc_id"] in (2, 3))
    assert language_model_report(frame(spark, []).limit(0)).collect() == []
    untaught = context_tree_scores(frame(spark, [(1, "ab", "en", "a")]), F.lit(False)).collect()[0]
    assert untaught["score"] == pytest.approx(24 * math.log10(0.5)) and untaught["train_tokens"] == 0


def test_spelling_of_a_batch():
    texts = ["A  b", "", "\tX", "Ü"]
    s = Spelling(pa.array(texts), WordHasher())
    assert s.stream.tobytes().decode() == "a b\n\nx\nÜ\n" and s.size.tolist() == [4, 1, 2, 3]
    key = s.runs(2)
    assert key[0] == ord("a") and key[2] == (ord(" ") << 16) | (ord("a") << 8) | ord("b") and key[4] == 10
    assert key[5] == ord("x") and np.all(key > 0)


# -- manifest -----------------------------------------------------------------------------------


def tree_of(digests, arity):
    """Root and, for each leaf, the siblings to its left and right by level."""
    proofs, nodes = [[] for _ in digests], [(d, [i]) for i, d in enumerate(digests)]
    while len(nodes) > 1:
        above = []
        for i in range(0, len(nodes), arity):
            run = nodes[i : i + arity]
            for j, (_, members) in enumerate(run):
                for m in members:
                    proofs[m].append(("".join(d for d, _ in run[:j]), "".join(d for d, _ in run[j + 1 :])))
            above.append((sha("".join(d for d, _ in run)), [m for _, ms in run for m in ms]))
        nodes = above
    return nodes[0][0], proofs


def brute_manifest(rows, arity):
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(row, more=0):
        i, t, lang, source, n = row
        return sha("".join(map(enc, (i, source, lang, None if n is None else n + more, t))))

    groups = {}
    for row in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))):
        groups.setdefault(row[2], []).append(row)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: tree_of([leaf(r) for r in groups[x]], arity) for x in langs}
    root, tops = tree_of([trees[x][0] for x in langs], arity)
    out = []
    for x, top in zip(langs, tops, strict=True):
        for row, own in zip(groups[x], trees[x][1], strict=True):
            proof = own + top
            node = leaf(row, 1 if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 else 0)
            for a, b in proof:
                node = sha(a + node + b)
            out.append((row[0], leaf(row), trees[x][0], root, sha("".join(a + b for a, b in proof)), node, node == root))
    return out


@pytest.mark.parametrize("arity", [2, 3])
def test_manifest_equals_brute_force(spark, arity):
    rng = random.Random(arity)
    rows = [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in edges(rng)]
    rows += [(100 + k, f"text {k}", rng.choice(["en", "en", "de", "Ä", "", "-"]), "a", k) for k in range(45)]
    rows += [(7 * 2**53 + 1, "big", "de", None, 2**63 - 1), (900, None, "only", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(6)
    got = manifest_report(clashing(df), arity).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_manifest(rows, arity)))


def test_manifest_of_few_and_no_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    one = manifest_report(spark.createDataFrame([(1, "a", "en", "s", 1)], schema)).collect()[0]
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof_sha256"] == sha("")
    assert manifest_report(spark.createDataFrame([], schema)).collect() == []


def test_changed_row_is_found_by_its_own_proof(spark):
    rows = spark.range(50).select("id", (F.col("id") % 3).alias("shelf"), leaf_digest([F.col("id")]).alias("leaf"))
    made = build_manifest(rows, "shelf", "id", "leaf")
    told = made.rows.select(
        (fold(F.col("leaf"), F.col("proof")) == made.root).alias("same"),
        (fold(leaf_digest([F.col("id") + 1]), F.col("proof")) == made.root).alias("other"),
    )
    assert {tuple(r) for r in told.collect()} == {(True, False)} and made.subroots.count() == 3
