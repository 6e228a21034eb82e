"""Small fixtures with every awkward row, each operator against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from patrolstat.llm import (ann, chat, components, deep_shallow, html_text, jaccard, mixing, mixing_lm, pieces, pii, quality,
                            queries, suffix_dedup)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, TEXT_LEN int, `a b` string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sentence(rng, n):
    return " ".join(rng.choice("the of and running water stone bright river mountain leaf cloud seven green old walking "
                               "under over forest light sound".split()) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    base = [sentence(rng, rng.randint(60, 160)) for _ in range(14)]
    out = [None, "", "   \n\t ", "one", "Two words", "é ñ 日本 😀 ▁ mark", base[0], base[0], base[0].upper(), base[1] + " tail",
           base[1], " ".join(base[2:9]), *base, "x" * 3000, "spam ham eggs " * 90, "a|b # c % " * 40,
           sentence(rng, 4000)]
    for b in base[:6]:
        w = b.split()
        w[len(w) // 2] = "changed"
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", None if i % 7 == 0 else f"s{i % 3}", len(t or ""), i, "z") for i, t in enumerate(texts)]
    rows += [rows[6], (None, texts[7], None, "s1", None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_words_are_hashed_alike_alone_and_together():
    from patrolstat.llm import wordhash
    h = wordhash.WordHasher()
    long = "word " * 300_000
    a = list(h.texts(["Ab c", None, long, " ab  C\n"]))
    assert a[0].tolist() == a[3].tolist() and len(a[1]) == 0
    assert len(a[2]) == 300_000 and len(set(a[2].tolist())) == 1


# 1 ---------------------------------------------------------------------------------------------------
def test_context_mixing_base_and_model(docs, empty):
    rows = docs.collect()
    got = mixing_lm.score(docs).collect()
    assert mixing_lm.score(empty).count() == 0
    tokens = [((r.text or "").encode().lower().split() + [None], str(r.doc_id) if r.doc_id is not None else "") for r in rows]
    seen = Counter()
    for w, k in tokens:
        if zlib.crc32(k.encode()) % 7 != 2:
            seen.update(w)
    n, v = sum(seen.values()), len(seen)
    want = Counter()
    for (w, k), r in zip(tokens, rows):
        base = sum(math.log10((seen[x] + 1) / (n + v + 1)) for x in w)
        want[(r.doc_id, zlib.crc32(k.encode()) % 7 == 2, len(w), sum(seen[x] > 0 for x in w), n, round(base, 6))] += 1
    assert want == Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got)
    assert all(r.score < 0 for r in got)
    per_byte = [r.bits_per_byte for r in got if r.n_bytes > 200]
    assert sum(per_byte) / len(per_byte) < 4


def test_prefix_code_and_probabilities_add_up():
    rng = np.random.default_rng(1)
    length, step = mixing_lm.prefix_code(rng.integers(0, 1000, 256))
    assert abs(sum(2.0 ** -length.astype(float)) - 1) < 1e-12
    # no two symbols share a path, and every inner node has a place of its own in the tables
    paths = [tuple(s[:n]) for s, n in zip(step.tolist(), length.tolist())]
    assert len(set(paths)) == 256 and len({s >> 1 for path in paths for s in path}) == 255
    assert max(s >> 1 for path in paths for s in path) < 1 << min(mixing_lm.TABLE_BITS)
    # one decision's two outcomes have probabilities that add up to one
    x = rng.normal(size=(mixing_lm.CONTEXTS, 1)).astype(np.float32)
    p = [2 ** mixing_lm.Mixer(*mixing_lm.start_weights()).log2(x, np.array([b]), [1]) for b in (0, 1)]
    assert abs(sum(p) - 1) < 1e-5


def test_counts_survive_packing():
    rng = np.random.default_rng(2)
    for share in (0.0, 0.05, 0.9):
        c = (rng.integers(0, 1 << 30, 2 * mixing_lm.SLOTS_PER_ROW) * (rng.random(2 * mixing_lm.SLOTS_PER_ROW) < share)).astype(np.int32)
        assert (mixing_lm._unpack(mixing_lm._pack(c)) == c).all()


def test_context_counts_are_exact(spark):
    rng = np.random.default_rng(3)
    shared = "".join(map(chr, rng.integers(33, 120, 900)))
    groups = [["".join(map(chr, rng.integers(33, 120, n))) + shared[: 300 * n] + " the same end"
               for n in (0, 17_000, 2, 16_300 + g)] + [None] for g in range(2)]
    groups = [[mixing_lm._symbols(t) for t in g] for g in groups]
    code = mixing_lm.prefix_code(np.bincount(np.concatenate(sum(groups, [])), minlength=256))
    coder, buckets, requests = mixing_lm.Coder(code), 5, []
    wide = mixing_lm.PASSAGE

    def passages(s):
        """Of each symbol: the bytes of its anchor, the distance since, and the last six bytes; None in front of a chunk's first."""
        whole, now, found = bytes(wide) + s.tobytes(), None, []
        for i in range(len(s)):
            if i % mixing_lm.CHUNK == 0:
                now = None
            front = whole[i: i + wide]
            if mixing_lm.passage_keys(s[i: i + 1], np.frombuffer(front, np.uint8), np.array([0]))[1][0] == 0:
                now = (front, i)
            reached = now is not None and i - now[1] < mixing_lm.REACH
            found.append((now[0], i - now[1], whole[i + wide - 6: i + wide]) if reached else None)
        return found

    behind = [[passages(s) for s in g] for g in groups]
    times = Counter(x[0] for g in behind for p in g for x in p if x and x[1] == 0)
    asked = [(gid, 0, mixing_lm._pack_pairs(k, n.astype(np.int32))) for gid, g in enumerate(groups) for k, n in [mixing_lm._anchors(g)]]
    schema = "gid long, chunk int, blob binary"
    again = mixing_lm._recurring(spark.createDataFrame(asked, schema), 1).toArrow()
    want = Counter()
    for gid, g in enumerate(groups):
        mine = again.filter(np.array(again.column("gid")) == gid)
        assert len(mixing_lm._names(mine)) == len({x[0] for p in behind[gid] for x in p if x and times[x[0]] > 1})
        keys, counts = mixing_lm._pairs(g, mixing_lm._names(mine))
        order, ends = mixing_lm._dealt(keys, buckets)
        for b, part in enumerate(np.split(order, ends[:-1])):
            requests.append((gid, b, mixing_lm._pack_pairs(keys[part], counts[part].astype(np.int32))))
        for s, passage in zip(g, behind[gid]):
            whole = bytes(6) + s.tobytes()
            for i, x in enumerate(s.tolist()):
                steps = code[1][x, : code[0][x]].tolist()
                for o in mixing_lm.ORDERS:
                    want.update((o, whole[6 + i - o: 6 + i], step) for step in steps)
                want.update((0, passage[i], step) for step in steps)
    got = mixing_lm._answers(spark.createDataFrame(requests, schema), code, buckets).toArrow()
    got = pa.concat_tables([got, again.cast(got.schema)])
    known = 0
    for gid, g in enumerate(groups):
        mine = got.filter(np.array(got.column("gid")) == gid)
        at = Counter()
        for i, ends, bit, codes in mixing_lm._decided(coder, g, mine, buckets, np.ones(len(g), bool)):
            part = g[i][at[i]: at[i] + len(ends)]
            whole, steps = bytes(6) + g[i].tobytes(), [code[1][x, : code[0][x]].tolist() for x in part.tolist()]
            for k, o in enumerate(mixing_lm.ORDERS):
                n = [(want[o, c, step & ~1], want[o, c, step | 1]) for j, path in enumerate(steps)
                     for c in [whole[6 + at[i] + j - o: 6 + at[i] + j]] for step in path]
                assert (mixing_lm._codes(np.array(n)) == codes[k]).all()
            n = [(want[0, c, step & ~1], want[0, c, step | 1]) if c and times[c[0]] > 1 else (0, 0)
                 for j, path in enumerate(steps) for c in [behind[gid][i][at[i] + j]] for step in path]
            assert (mixing_lm._codes(np.array(n)) == codes[-1]).all()
            known += int((codes[-1] > 0).sum())
            at[i] += len(ends)
        assert [at[i] for i in range(len(g))] == [len(s) for s in g]
    assert known > 2_000


def test_places_and_turned_codes():
    rng = np.random.default_rng(5)
    texts = [rng.integers(97, 101, n).astype(np.uint8) for n in (0, 1, 40, 700)] * 2
    anchors, times = mixing_lm._anchors(texts)
    keys, places = mixing_lm._places(texts, anchors[times > 1])
    assert (keys == mixing_lm._pairs(texts, anchors[times > 1])[0]).all()
    at = 0
    for piece in mixing_lm._pieces(texts):
        for place, (key, own) in zip(places, mixing_lm._piece_keys(piece, anchors[times > 1])):
            mine = place[at: at + len(key)]
            own = np.ones(len(key), bool) if own is None else own
            assert (keys[mine[own]] == key[own]).all() and (mine[~own] == len(keys)).all()
        at += len(key)
    coder, codes = mixing_lm.Coder(mixing_lm.prefix_code(np.arange(256))), rng.integers(0, 256, 5_000).astype(np.uint8)
    symbols = np.repeat(np.arange(256), 2)
    codes = codes[: coder.length[symbols].sum()]
    assert (mixing_lm._turn(coder, symbols, mixing_lm._turn(coder, symbols, codes)) == codes).all()
    # a path taken by all counts of its context looks the same at every node
    keys, counts = np.arange(256, dtype=np.uint64) * np.uint64(257), np.full(256, 3)
    path, _ = mixing_lm._path_codes(coder, keys, counts)
    assert len(set(mixing_lm._turn(coder, np.arange(256), path).tolist())) == 1


def test_keys_are_ranked_whatever_their_parts():
    rng = np.random.default_rng(6)
    key = rng.integers(0, 1 << 62, 150_000, dtype=np.uint64)[rng.integers(0, 150_000, 150_000)]
    key[:100_000] = (key[0] >> np.uint64(17) << np.uint64(17)) + rng.integers(0, 1 << 17, 100_000).astype(np.uint64)  # one hot part
    for n, bits in ((0, 62), (1, 62), (150_000, 62), (150_000, 40)):
        found, place = mixing_lm._ranked(key[:n] >> np.uint64(62 - bits), bits)
        want, where = np.unique(key[:n] >> np.uint64(62 - bits), return_inverse=True)
        assert (found == want).all() and (place == where).all()


def test_texts_are_mixed_side_by_side_as_alone():
    """Texts of one to many blocks, together: each the same bits, weights and refinement as alone."""
    rng = np.random.default_rng(7)
    logits, parts = mixing_lm._tables()[0], []
    for n in (1, 129, 5_000, 128, 900):
        times = rng.integers(1, 20, n)
        bit = rng.integers(0, 2, times.sum()).astype(np.uint8)
        codes = rng.integers(0, 256, (mixing_lm.CONTEXTS, len(bit))).astype(np.uint8)
        parts.append((np.where(rng.random(codes.shape) < 0.3, 0, codes).astype(np.uint8), bit, mixing_lm._edges(np.cumsum(times))))
    together, alone = ([mixing_lm.Mixer(*mixing_lm.start_weights()) for _ in parts] for _ in range(2))
    got = mixing_lm._log2(together, parts, logits)
    for k, (codes, bit, edges) in enumerate(parts):
        assert alone[k].log2(logits.take(codes), bit, edges) == got[k]
        assert (alone[k].w == together[k].w).all() and (alone[k].apm == together[k].apm).all()
        # and as block by block, by the definition
        w, apm = mixing_lm.start_weights()
        x, at, total = logits.take(codes).astype(float), 0, 0.0
        for end in edges:
            xs, y = x[:, at:end], bit[at:end].astype(float)
            gate = (xs != 0).sum(axis=0)
            t = np.clip((w[gate].T * xs).sum(axis=0), -11.9, 11.9)
            p, cell = 1 / (1 + np.exp(-t)), (t * 32 / 24 + 16.5).astype(int)
            q = (p + apm[gate, cell]) / 2
            total += np.log2(np.maximum(np.where(y == 1, q, 1 - q), 2.0 ** -16)).sum()
            for g in range(len(w)):
                w[g] += mixing_lm.RATE / np.sqrt(end - at) * (xs[:, gate == g] @ (y - p)[gate == g])
                for c in range(mixing_lm.BUCKETS):
                    met = (gate == g) & (cell == c)
                    if met.any():
                        apm[g, c] += (1 - (1 - mixing_lm.APM_RATE) ** met.sum()) * (y[met].mean() - apm[g, c])
            at = end
        assert abs(total - got[k]) < 1e-3 * abs(total)


def test_passages_keep_their_order_in_buckets():
    """Passages are dealt by ranges of their hash: a group's answers come in the order of its keys, with few far steps to pack."""
    rng = np.random.default_rng(9)
    tag = np.uint64(len(mixing_lm.ORDERS) << mixing_lm.TAG)
    keys = np.unique(np.concatenate((rng.integers(0, 1 << 24, 500, dtype=np.uint64), rng.integers(0, 1 << 62, 4_000, dtype=np.uint64) | tag)))
    for buckets in (1, 7, 300):
        order, ends = mixing_lm._dealt(keys, buckets)
        assert sorted(order.tolist()) == [*range(len(keys))] and len(ends) == buckets and ends[-1] == len(keys)
        passages = order[keys[order] >= tag]
        assert (np.diff(passages) == 1).all()
        bucket = np.searchsorted(ends, np.arange(len(keys)), "right")
        of: dict = {}
        for key, b in zip((keys[order] >> np.uint64(22)).tolist(), bucket.tolist()):
            if key >= int(tag) >> 22:
                assert of.setdefault(key, b) == b


def test_base_counts_words_as_groups_ask(spark, monkeypatch):
    """Words are asked for by group: what is written is by group, with no row for a word of a text."""
    monkeypatch.setattr(mixing_lm, "GROUP_BYTES", 400)
    written, cut = [], mixing_lm.cut
    monkeypatch.setattr(mixing_lm, "cut", lambda df: written.append(df.columns) or cut(df))
    rows = [(i, f"one two Two w{i} w{i % 3}") for i in range(60)] + [(60, None), (None, "one")]
    got = mixing_lm.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    train = [(t or "").lower().split() for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    seen = Counter(w for t in train for w in t)
    n, v = sum(seen.values()) + len(train), len(seen) + 1
    assert {r.train_tokens for r in got} == {n} and len(got) == len(rows)
    assert all("gid" in columns or "score" in columns for columns in written)
    for r in got:
        words = (dict(rows)[r.doc_id] or "").lower().split()
        base = sum(math.log10((c + 1) / (n + v + 1)) for c in [*(seen[w] for w in words), len(train)])
        assert (r.n_tokens, r.n_known) == (len(words) + 1, sum(seen[w] > 0 for w in words) + 1) and abs(r.base_score - base) < 1e-9


def test_blocks_start_short():
    ends = np.arange(1, 5001) * 3
    edges = mixing_lm._edges(ends)
    assert edges[:4] == [3 * 128, 3 * 384, 3 * 896, 3 * 1920] and edges[-1] == 15_000 and edges == sorted(set(edges))
    assert mixing_lm._edges(ends[:128]) == [384] and mixing_lm._edges(ends[:1]) == [3]


def test_model_beats_its_base_on_held_out_texts(spark):
    """Passages that training texts share, inside texts that are new, cost few bits."""
    rng = np.random.default_rng(8)
    words = ["".join(map(chr, rng.integers(97, 123, rng.integers(2, 9)))) for _ in range(3_000)]
    passages = [" ".join(rng.choice(words, 40)) for _ in range(60)]
    rows = [(i, " ".join(rng.choice(words, 30)) + " " + passages[rng.integers(60)] + ".") for i in range(900)]
    got = [r for r in mixing_lm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.held_out]
    assert len(got) > 90 and sum(r.score for r in got) > 0.9 * sum(r.base_score for r in got)


def test_starting_weights_come_from_all_training_texts(spark, monkeypatch):
    rows = [(i, f"text {i} of many") for i in range(700)]
    seen, fitted = [], mixing_lm.fitted
    monkeypatch.setattr(mixing_lm, "fitted", lambda cells, n0, n1: seen.append(int((n0 + n1).sum())) or fitted(cells, n0, n1))
    mixing_lm.score(spark.createDataFrame(rows, "doc_id long, text string"))
    train = np.concatenate([mixing_lm._symbols(t) for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2])
    hist = np.bincount(train, minlength=256)
    assert seen == [int((hist * mixing_lm.prefix_code(hist)[0]).sum())]


def test_context_mixing_follows_no_partitioning(docs):
    a, b = (sorted((str(r.doc_id), r.n_bytes, round(r.score, 4)) for r in mixing_lm.score(docs.repartition(n)).collect()) for n in (1, 5))
    assert a == b


# 2 ---------------------------------------------------------------------------------------------------
def test_quality_features_and_verdict(docs, empty):
    found = quality.cascade(docs, features=quality.BASE_COLUMNS)
    assert found.columns[: len(docs.columns)] == docs.columns and quality.cascade(empty).count() == 0
    for r in found.collect():
        t = r.text or ""
        w = WORD.findall(t)
        windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        c = Counter(windows)
        repeat = {j for i, x in enumerate(windows) if c[x] > 1 for j in (i, i + 1, i + 2)}
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), sum(map(len, w)), len(repeat))
        if len(w) < 50 or 100 * len(repeat) > 50 * len(w):
            assert r.failed_rule is not None


def test_quality_order_changes_no_verdict(docs):
    a = quality.cascade(docs, list(quality.RULES)).select("doc_id", "failed_rule").collect()
    b = quality.cascade(docs, list(quality.RULES)[::-1]).select("doc_id", "failed_rule").collect()
    keep = lambda rows: Counter((r.doc_id, r.failed_rule is None) for r in rows)
    assert keep(a) == keep(b) == keep(quality.cascade(docs).select("doc_id", "failed_rule").collect())
    assert quality.order_rules({"symbols": (1.0, 0.5), "too_short": (1.0, 0.9)})[:2] == ["too_short", "symbols"]
    assert quality.keep_good(docs).columns == docs.columns


# 3 ---------------------------------------------------------------------------------------------------
def test_n_best_is_exact():
    v, rng = pieces.load(), random.Random(3)
    side, encoder = pieces.SideBySide(v), pieces.Encoder(v, 5)

    def every(text):
        lattice, out = pieces.Lattice(text, v), []

        def walk(at, score, back):
            if at == 0:
                out.append((-score, back))
            else:
                for i, s, ids in lattice.ends[at]:
                    walk(i, score + s, back + ids[::-1])
        walk(lattice.n, 0, ())
        return [(-s, b[::-1]) for s, b in sorted(out)]

    for n in range(1, 9):
        chunks = ["".join(rng.choice("▁aathein\ud800é日😀") for _ in range(n)) for _ in range(25)]
        for c, fast in zip(chunks, side.solve(chunks)):
            b, lattice = every(c), pieces.Lattice(c, v)
            assert lattice.n_best(4) == b[:4]
            two = (*b[0], b[0][0] - b[1][0] if len(b) > 1 else None)
            assert lattice.best_two() == two and fast in (None, two)
    for _ in range(60):
        t = "".join(rng.choice(" athe\n▁x") for _ in range(rng.randint(1, 9)))
        ids, ranked = encoder.encode(t)
        b = every(pieces.MARK + t.replace(pieces.MARK, pieces.LITERAL).replace(" ", pieces.MARK))
        assert [s for s, _ in ranked] == [s for s, _ in b[:5]] and tuple(ids) == b[0][1]
        for s, edits in ranked:
            other = list(ids)
            for i, j, new in sorted(edits, reverse=True):
                other[i:j] = new
            assert (s, tuple(other)) in b


def test_pieces_round_trip(docs, empty):
    got = pieces.decode(pieces.encode(docs))
    assert all(r.text == r.decoded for r in got.collect()) and pieces.decode(pieces.encode(empty)).count() == 0


# 4 ---------------------------------------------------------------------------------------------------
def test_chat_examples(spark):
    rows = [(1, 0, "system", "be ~0 <|end|> nice"), (1, 1, "user", None), (1, 2, "assistant", "[INST] </s> ~1"), (1, 3, "user", "q"),
            (1, 4, "assistant", "a <|turn:user|>"), (2, 0, "user", "only"), (3, 0, "assistant", ""), (None, None, None, "n"),
            (4, 1, "assistant", "same"), (4, 1, "assistant", "same"), (4, 0, "a|b<c", "x\ny")]
    turns = spark.createDataFrame([(*r, 5) for r in rows], "conv_id long, turn long, role string, text string, N int")
    rendered = chat.render(turns)
    examples = chat.expand(rendered).collect()
    first = next(e for e in examples if e.conv_id == 1 and e.example == 0)
    assert first.text.endswith("[INST] </s> ~1".replace("~", "~0").replace("<", "~1").replace("[", "~2").replace("]", "~3") + "<|end|>")
    assert sum(e.conv_id == 1 for e in examples) == 2
    convs = {}
    for r in rows:
        convs.setdefault(r[0], []).append(r)
    for r in chat.read_back(chat.expand(rendered)).collect():
        own = sorted(convs[r.conv_id], key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        turns_text = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in own)
        loss = "".join(x[3] or "" for x in own if x[2] == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(own), hashlib.sha256(turns_text.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.read_back(chat.expand(chat.render(turns.limit(0)))).count() == 0


def test_chat_is_read_back_without_prefixes(spark):
    rows = [(1, 0, "user", "a<b~[x]|é 😀"), (1, 1, "assistant", "c<|end|>d"), (1, 2, "user", None), (2, 0, "user", "only"), (3, 0, "assistant", ""),
            (None, 1, None, "x"), (None, 1, "assistant", "y"), (4, 0, "as|<sistant", "z\n"), (4, 1, "assistant", "<|turn:user|>")]
    rendered = chat.render(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    want = chat.read_back(chat.expand(rendered))
    got = chat.read_back_examples(rendered, chat.examples(rendered))
    assert chat.examples(rendered).count() == chat.expand(rendered).count()
    spans = {(e.conv_id, e.example): (e.end, e.loss_start, e.loss_end) for e in chat.examples(rendered).collect()}
    assert spans == {(e.conv_id, e.example): (len(e.text), e.loss_start, e.loss_end) for e in chat.expand(rendered).collect()}
    assert got.dtypes == want.dtypes and Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    # a conversation whose examples hold 50 G characters
    n, said = 10_000, "word " * 200
    turns = spark.range(n).select(chat.F.lit(1).alias("conv_id"), chat.F.col("id").alias("turn"), chat.F.lit("assistant").alias("role"),
                                  chat.F.lit(said).alias("text"))
    each = len("<|turn:assistant|><|end|>") + len(said)
    rendered = chat.render(turns)
    [r] = chat.read_back_examples(rendered, chat.examples(rendered)).collect()
    assert (r.n_turns, r.loss_chars, r.formatted_chars) == (n, n * len(said), each * n * (n + 1) // 2)
    assert r.loss_sha256 == hashlib.sha256((said * n).encode()).hexdigest()


def test_chat_examples_are_written_whole(spark):
    rows = [(c, i, r, f"{c} <|end|> [{i}] ~ é😀" * (i % 4)) for c in (1, 2, None) for i, r in enumerate(["system"] + ["user", "assistant"] * 6 + ["user"])]
    rows += [(3, 0, "assistant", "x" * 200), (3, 1, "user", "y"), (4, 0, "user", "only")]
    rendered = chat.render(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    want = {(e.conv_id, e.example): (e.text, e.loss_start, e.loss_end) for e in chat.expand(rendered).collect()}
    digests = Counter(map(tuple, chat.read_back(chat.expand(rendered)).collect()))
    for part_chars in (1, 40, 100, chat.PART_CHARS):
        written = chat.written(rendered, chat.examples(rendered), part_chars).cache()
        got = {}
        for e in sorted(written.collect(), key=lambda e: e.part):
            text, *_ = got.get((e.conv_id, e.example), ("",))
            assert e.start == len(text)
            got[e.conv_id, e.example] = (text + e.text, e.loss_start, e.loss_end)
        assert got == want and (part_chars < 1000 or written.count() == len(want))
        assert Counter(map(tuple, chat.read_written(written).collect())) == digests
        # what is read back is the texts: a context changed in the output shows
        other = written.withColumn("text", chat.F.replace("text", chat.F.lit("only"), chat.F.lit("other")))
        changed = Counter(map(tuple, chat.read_written(other).collect())) - digests
        assert [r[0] for r in changed] == [4] and [r[5] for r in changed] == [len(want[4, 0][0]) + 1]
        written.unpersist()


def test_chat_query_writes_its_examples(spark, monkeypatch, scratch):
    rows = [(1, 0, "user", "q" * 60), (1, 1, "assistant", "a"), (1, 2, "user", "b"), (1, 3, "assistant", "c")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{scratch}/conversations.parquet")
    seen, whole = [], chat.written
    monkeypatch.setattr(chat, "written", lambda *a: seen.append(whole(*a)) or seen[0])
    got = {r.conv_id: r for r in queries.op4_chat(spark, str(scratch)).collect()}
    texts = Counter()
    for e in seen[0].collect():
        texts[e.conv_id] += len(e.text)
    assert texts == {c: r.formatted_chars for c, r in got.items()} and texts[1] > 2 * 60


# 5 ---------------------------------------------------------------------------------------------------
def test_deep_shallow_sort():
    rng = random.Random(1)
    for _ in range(500):
        s = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, rng.choice([3, 12, 30])))) for _ in range(rng.randint(1, 12))]
        order, lcp = deep_shallow.deep_shallow_sort(s, shallow=rng.choice([0, 1, 3, 8]))
        assert [s[i] for i in order] == sorted(s)
        assert lcp == [-1] + [deep_shallow.common_prefix(s[a], s[b]) for a, b in zip(order, order[1:])]


def removed(docs, length):
    c = Counter(d[i:i + length] for d in docs for i in range(len(d) - length + 1))
    out = []
    for d in docs:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if c[d[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        out.append((len(d), sum(gone), bytes(x for x, g in zip(d, gone) if not g)))
    return Counter(out)


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 4, 1])
def test_repeats_are_removed_exactly(docs, empty, hot):
    got = suffix_dedup.remove_repeats(docs, length=40, gram=12, hot=hot)
    assert got.columns[: len(docs.columns)] == docs.columns
    have = Counter((r.n_bytes, sum(x.end - x.start for x in r.removed), bytes(r.kept)) for r in got.collect())
    assert have == removed([(r.text or "").encode() for r in docs.collect()], 40)
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_a_gram_in_many_contexts_is_split_not_gathered(spark):
    rng = random.Random(5)
    gram = "0123456789ab"
    texts = ["".join(rng.choice("xy") for _ in range(rng.randint(0, 30))) + gram * rng.randint(1, 2)
             + "".join(rng.choice("xy") for _ in range(rng.randint(0, 30))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = removed([t.encode() for t in texts], 24)
    for hot in (1_000, 20, 1):
        got = suffix_dedup.remove_repeats(docs, length=24, gram=12, hot=hot)
        assert Counter((r.n_bytes, sum(x.end - x.start for x in r.removed), bytes(r.kept)) for r in got.collect()) == want


# 6 ---------------------------------------------------------------------------------------------------
def test_personal_data(spark):
    texts = [None, "", "mail a.b@c-d.example.org, x@y or b.c_d@e.f@g.h", "ip 10.0.0.255 10.0.0.256 1.2.3.4.5.6.7.8 001.02.3.4",
             "card 4111 1111 1111 1111 and 4111-1111-1111-1112 " + "7" * 400, "call +1 (555) 010-9999. or +123 or +49.30.1234567",
             "IBAN DE89370400440532013000 or DE89370400440532013001", "ssn 123-45-6789 and 123-45-6789 far " + "z" * 60 + " 321-54-9876",
             "a" * 5000 + "1" * 5000]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, SPANS2 int")
    got = {r.doc_id: r for r in pii.digest(pii.detect(df)).collect()}
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def ok(kind, s):
        d = re.sub("[^0-9]", "", s)
        if kind == "ip":
            return all(int(x) <= 255 for x in s.split("."))
        if kind == "card":
            return 12 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0
        return kind == "email" or 9 <= len(d) <= 15

    for i, t in enumerate(texts):
        if i == len(texts) - 1:  # the plain patterns are quadratic here; there is nothing to find
            spans = []
        else:
            spans = sorted((m.start(), k, m.end()) for k, p in enumerate(patterns.values()) for m in re.finditer(p, t or "")
                           if ok(list(patterns)[k], m[0]))
        text = ",".join(f"{list(patterns)[k]}:{s}:{e}" for s, k, e in spans)
        assert got[i].base_sha256 == hashlib.sha256(text.encode()).hexdigest(), t
    assert got[6].spans.count("iban") == 1 and got[7].spans.count("ssn") >= 1 and "ssn:" + str(texts[7].index("321")) not in got[7].spans
    masked = {r.doc_id: r.text for r in pii.mask(df).collect()}
    assert masked[0] is None and masked[4].startswith("card [CARD] and 4111") and masked[2].startswith("mail [EMAIL], x@y")
    assert pii.digest(pii.detect(df.limit(0))).count() == 0


def test_context_window_is_the_same_everywhere(spark):
    """A context word 21 characters behind a span is out of reach, wherever the span stands."""
    span, far = "123-45-6789", " " * 20 + "ssn"
    texts = [pre + span + gap + "ssn" for pre in ("", "z " * 10, "z " * 61) for gap in (" " * 17, " " * 20)]
    texts += ["ssn" + " " * 37 + span, "ssn" + " " * 38 + span, "a@b.c 1.2.3.4 " + span + " 1.2.3.4 a@b.c ssn"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.spans.count("ssn:") for r in pii.digest(pii.detect(df)).orderBy("doc_id").collect()]
    assert got == [1, 0] * 3 + [1, 0, 1], far


def test_many_matches_and_a_clashing_name(spark):
    n = 8_000
    df = spark.createDataFrame([(1, "user.name@mail.example " * n, "kept")], "doc_id long, text string, Spans string")
    found = pii.detect(df)
    assert found.columns == ["doc_id", "text", "Spans", "spans_"] and found.first().Spans == "kept"
    got = pii.digest(found, spans="spans_").first()
    assert got.n_email == n and got.spans.endswith(f"email:{23 * (n - 1)}:{23 * n - 1}")


def test_clashing_feature_names(spark):
    df = spark.createDataFrame([(1, "a b", 7)], "doc_id long, text string, N_Words long")
    assert quality.cascade(df, features=("n_words",)).columns == ["doc_id", "text", "N_Words", "failed_rule", "n_words_"]


def test_mix_broadcasts_nothing_that_grows(docs, capsys):
    for made in (mixing.mix(docs), mixing.mix_documents(docs.drop("TEXT_LEN", "a b"))):
        capsys.readouterr()
        made.explain()
        plan = capsys.readouterr().out
        assert "BroadcastExchange" not in plan and "BroadcastHashJoin" not in plan


def test_pieces_decoded_in_the_same_pass(docs):
    both = pieces.decode(pieces.encode(docs.select("doc_id", "text"), decoded="DOC_ID"), out="again")
    assert both.columns[-2:] == ["DOC_ID_", "again"]
    assert both.filter("not (text <=> DOC_ID_) or not (again <=> DOC_ID_)").count() == 0


def test_batches_are_cut_by_bytes():
    import pyarrow as pa

    from patrolstat.llm.common import parts
    texts = [None, "a" * 10, "b" * 100, "", None, "c" * 5, "d" * 30, "é" * 20]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts)], ["i", "t"])
    cut = list(parts([batch, batch.slice(0, 0), batch.slice(3)], 1, 40))
    assert [x for b in cut for x in b.column(1).to_pylist()] == texts + texts[3:]
    assert len(cut) == 4 and all(b.num_rows == 1 or b.slice(0, b.num_rows - 1).column(1).nbytes < 40 + 200 for b in cut)


ALONE = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as e
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.checkpoint.dir", {scratch!r}).getOrCreate())
for name in {names!r}:
    assert e.queries()[name](spark, {data!r}).count() > 0, name
print("all ran")
"""


def test_executors_need_no_copy_of_the_package(spark, scratch):
    """Workers started where the repository is on no path: what they run travels with the job."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    repo = str(Path(__file__).resolve().parents[2])
    (scratch / "data").mkdir()
    for t in ("documents", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").limit(30).write.parquet(str(scratch / "data" / f"{t}.parquet"))
    names = ["op1_context_mixing", "op2_quality", "op3_pieces", "op5_suffix_dedup", "op8_jaccard", "op11_merkle", "op12_resample", "op13_licenses"]
    code = ALONE.format(repo=repo, scratch=str(scratch / "ckpt"), names=names, data=str(scratch / "data"))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONPATH": ""}
    done = subprocess.run([sys.executable, "-c", code], cwd=scratch, env=env, capture_output=True, text=True, timeout=900)
    assert "all ran" in done.stdout, done.stderr[-3000:]


def test_account_numbers_before_words(spark):
    known = ["BE68 5390 0754 7034", "ES91 2100 0418 4502 0005 1332", "BE68539007547034", "DE89 3704 0044 0532 0130 00", "FR14 2004 1010 0505 0001 3M02 606",
             "PL61 1090 1014 0000 0712 1981 2874", "NO93 8601 1117 947"]
    after = ["", " BIC", " EUR", " KONTO", " KONTONUMMER", " A", " bank", " DE89 3704 0044 0532 0130 01", ".", " 1234 5678"]
    rows = [(i, f"AB12 pay to {k}{a}") for i, (k, a) in enumerate((k, a) for k in known for a in after)]
    both = "to BE68 5390 0754 7034 DE89 3704 0044 0532 0130 00 EUR"
    rows += [(1000, both), (1001, "BE68 5390 0754 7035 EUR"), (1002, "XBE68 5390 0754 7034"), (1003, "BE68539007547034BIC")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == "iban"] for r in pii.detect(df).collect()}
    for i, t in rows[:-4]:
        k = known[i // len(after)]
        assert got[i] == [(t.index(k), t.index(k) + len(k))], t
    assert got[1000] == [(3, 22), (23, 50)] and got[1001] == got[1002] == got[1003] == []
    assert {r.text for r in pii.mask(df.filter("doc_id = 1000")).collect()} == {"to [IBAN] [IBAN] EUR"}


# 7 ---------------------------------------------------------------------------------------------------
PAGE = """<html><head><title>T</title><style>p{}</style><script>var a="</p><p>x";</script></head><body><nav><ul><li><a href=/>Home</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies on this page, please agree to all of them now</p></div><!-- <p>no</p> -->
%s<h1>Head &amp; line</h1><p>First <b>para</b>graph
 with &eacute; and&nbsp;more words to be long enough for a window.<p>Short.<div class="ad"><p>Buy now, it is cheap and good and everyone wants it</p></div>
<p>Last paragraph of the text with a <a href="/x">link</a> in it, and it also goes on for a while.</p>%s
<aside>Side text which is quite long too, longer than any of the windows need</aside><form><p>Your name</p></form>
<div id="comments"><p>Reader: I do not agree with a word of it, and here is why, in detail</p></div><footer>&copy; us</footer></body></html>"""
ARTICLE = ("Head & line\nFirst paragraph with é and more words to be long enough for a window.\nShort.\n"
           "Last paragraph of the text with a link in it, and it also goes on for a while.")


def test_main_text(spark):
    pages = [PAGE % ("<article>", "</article>"), PAGE % ("", ""), None, "", "<p>", "plain words", "<nav>a<article><p>In.</p>", PAGE % ("<article>", "")]
    df = spark.createDataFrame([(i, p, "t") for i, p in enumerate(pages)], "page_id long, html string, Text string")
    got = {r[0]: r[3] for r in html_text.extract(df).collect()}
    assert got[0] == got[1] == got[7] == ARTICLE
    assert [got[i] for i in range(2, 7)] == ["", "", "", "plain words", "In."]
    assert html_text.extract(df.limit(0)).count() == 0


def test_main_text_in_elements_with_marking_names():
    """Class words that tell a state, or name part of an element that holds the text, lose nothing."""
    text = [f"Paragraph {i} of the story goes on for a while, so that it is long enough." for i in range(4)]
    story = "".join(f"<p>{x}</p>" for x in text)
    menu, notes = '<div class="menu"><p>Home and all of the other places to go</p></div>', '<div class="comments"><p>I say so.</p></div>'
    for name in ("has-sidebar", "post no-comments", "widget-area-free", "alert-free story", "layout-sidebar", "page two-column_sidebar"):
        assert html_text.main_text(f'<body>{menu}<div class="{name}">{story}</div>{notes}</body>') == "\n".join(text), name
        nested = f'<body>{menu}<div class="{name}"><div class="wide-widget">{story}{notes}</div></div></body>'
        assert html_text.main_text(nested) == "\n".join(text), name
    article = f'<article><h1>Head</h1><div class="post comments-open">{story}</div>{notes}</article>'
    assert html_text.main_text(f"<body>{menu}{article}</body>") == "\n".join(["Head", *text])
    # what such a name marks beside the story is left out, as is a longer block whose own name says what it is
    aside = '<div class="layout-sidebar"><p>Elsewhere on these pages, in short.</p></div>'
    assert html_text.main_text(f"<body><div>{story}</div>{aside}</body>") == "\n".join(text)
    long = '<div id="comments">' + "<p>A reader says a good deal about it, and then some more of it.</p>" * 20 + "</div>"
    assert html_text.main_text(f"<body><div>{story}</div>{long}</body>") == "\n".join(text)
    deep = '<div class="x-ad">' * 3_000 + story
    assert html_text.main_text(deep) == ""
    assert html_text.main_text(deep[-8 * len('<div class="x-ad">') - len(story):]) == "\n".join(text)


def test_main_text_around_marked_blocks():
    first, second = "first words " * 40, "second words " * 30
    marked = '<div class="ad">Buy</div><aside>Side</aside><div class="share">Share</div>'
    assert html_text.main_text(f"<p>{first}</p>{marked}<p>{second}</p>") == f"{first.strip()}\n{second.strip()}"
    links = '<p>See <a href="/x">a long description of the source</a></p>'
    menu = '<ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul>'
    assert (html_text.main_text(f"{menu}<p>{first}</p>{links}<p>{second}</p>{menu}")
            == f"{first.strip()}\nSee a long description of the source\n{second.strip()}")


# 8 ---------------------------------------------------------------------------------------------------
def brute_classes(rows, width, percent):
    sets, own = [], {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        k = min(width, len(w))
        sets.append((i, frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if w else frozenset()))
    up = {i: i for i, _ in sets if i is not None}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(len(sets)):
        for b in range(a):
            (i, x), (j, y) = sets[a], sets[b]
            if i is not None and j is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((top(i), top(j)))
                up[q] = p
    return Counter((i, len(s), top(i) if i is not None else None) for i, s in sets)


@pytest.mark.parametrize("width,percent,group", [(4, 85, 64), (2, 60, 1), (1, 50, 3)])
def test_classes(spark, docs, empty, width, percent, group, monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP", group)
    rng = random.Random(width)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for i in range(60):
        w = sentence(random.Random(i % 6), 30).split()
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = rng.choice(["river", "new", "stone"])
        rows.append((500 + i, " ".join(w)))
    rows += [(600, rows[30][1]), (600, rows[40][1])]  # one id, two texts
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("N", jaccard.F.lit(1))
    got = Counter(tuple(r) for r in jaccard.classes(df, width=width, percent=percent).collect())
    assert got == brute_classes(rows, width, percent)
    if width == 4:
        assert jaccard.classes(empty).count() == 0
        kept = jaccard.keep_representatives(docs)
        assert kept.columns == docs.columns and kept.filter("doc_id = 7").count() == 0


def test_one_row_of_each_class_stays(spark):
    a, b, c = (sentence(random.Random(i), 60) for i in range(3))
    near = a.replace(a.split()[30], "changed", 1)
    rows = [(1, a, 1), (1, a, 2), (2, a, 3), (None, near, 4), (None, b, 5), (None, b, 6), (3, c, 7), (3, b, 8), (None, "", 9), (4, None, 10), (None, "", 11)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `a b` int").withColumn("m", jaccard.F.create_map(jaccard.F.lit("k"), "a b"))
    kept = jaccard.keep_representatives(df)
    assert kept.columns == df.columns
    got = [tuple(r)[:3] for r in kept.collect()]
    assert Counter((r[0], r[1]) for r in got) == Counter([(1, a), (3, b), (3, c), (None, ""), (4, None), (None, "")])
    assert all(r in rows for r in got)


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)] + [
        (rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    up = {}

    def top(x):
        up.setdefault(x, x)
        return x if up[x] == x else top(up[x])
    for a, b in edges:
        if a is not None and a != b:
            p, q = sorted((top(a), top(b)))
            up[q] = p
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {x: top(x) for x in up}


# 9 ---------------------------------------------------------------------------------------------------
def test_mixing(docs, empty):
    rows = mixing.mix(docs).collect()
    assert mixing.mix(empty).count() == 0
    source = Counter()
    size = {}
    for r in docs.collect():
        n = len(WORD.findall(r.text or ""))
        source[r.source] += n
        size[r.doc_id] = n
    order = sorted(source, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, target, total = set(order), {}, 1.5 * sum(source.values())
    while left:
        share = (total - sum(target.values())) / sum(weight[s] for s in left)
        over = {s for s in left if share * weight[s] > 2 * source[s]}
        target |= {s: 2.0 * source[s] for s in over} if over else {s: share * weight[s] for s in left}
        left -= over or left
    of_source = {r.doc_id: r.source for r in docs.collect()}
    taken = Counter()
    for r in rows:
        s = of_source[r.doc_id]
        assert r.size == size[r.doc_id] and r.taken <= 2 * r.size and r.source_size == source[s]
        assert abs(r.target - target[s]) < 1e-6 * max(1, target[s])
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 4 * mixing.BLOCK_WORDS for s in order)
    key = lambda rs: sorted((str(r.doc_id), r.size, r.taken) for r in rs)
    assert key(rows) == key(mixing.mix(docs.repartition(5)).collect())


def test_mixed_documents(docs, empty):
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns and mixing.mix_documents(empty).count() == 0
    whole = {r.doc_id: WORD.findall(r.text or "") for r in docs.collect()}
    n = Counter()
    for r in out.collect():
        words = WORD.findall(r.text)
        n[r.doc_id] += len(words)
        it = iter(whole[r.doc_id])
        assert all(w in it for w in words) and r.n_chars == len(r.text)
    assert sum(n.values()) == sum(r.taken for r in mixing.mix(docs).collect())


def test_mix_moves_texts_once(docs, capsys):
    made = mixing.mix_documents(docs)
    capsys.readouterr()
    made.explain(mode="formatted")
    moved = re.findall(r"^\(\d+\) Exchange\s*\n(?:Input|Output) \[\d+\]: (.*)$", capsys.readouterr().out, re.M)
    text = f"_c{docs.columns.index('text')}#"
    assert len(moved) > 3 and sum(text in columns for columns in moved) == 1


def test_mixed_rows_keep_their_own_columns(spark):
    """Rows equal in id, source and text are told apart: every row goes with its own other columns, at most once a pass."""
    rows = [(1 if i % 3 else None, f"word{i % 2} " * 40, "s", i) for i in range(60)]
    out = mixing.mix_documents(spark.createDataFrame(rows, "doc_id long, text string, source string, mine int"))
    taken = Counter()
    for r in out.collect():
        assert r.doc_id == rows[r.mine][0] and r.text in rows[r.mine][1]
        taken[r.mine] += len(WORD.findall(r.text))
    assert max(taken.values()) <= 2 * 40 and abs(sum(taken.values()) - 1.5 * 60 * 40) <= 4 * mixing.BLOCK_WORDS


def test_permutation(spark):
    for n in (1, 2, 7, 100):
        df = spark.range(n).select(mixing.permuted(mixing.F.col("id"), mixing.F.lit(n), mixing.F.lit(3)).alias("p"))
        assert sorted(r.p for r in df.collect()) == list(range(n))


# 10 --------------------------------------------------------------------------------------------------
def test_pairs_come_in_order():
    rng = np.random.default_rng(0)
    a, b = rng.random(7), rng.random(5)
    pairs = list(ann.pairs_by_distance(a, b))
    assert len(set(pairs)) == 35
    d = [a[i] + b[j] for i, j in pairs]
    assert d == sorted(d)


def test_search(spark, monkeypatch):
    monkeypatch.setattr(ann, "PIECE_ROWS", 40)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(700, 8)) + 4 * rng.integers(0, 3, size=(700, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1000 + i, x[100].tolist()) for i in range(60)]
    rows += [(2000, None), (2100, [0.0] * 8), (2200, [1.0, None] * 4), (2300, [math.nan] * 8), (2400, [math.inf] * 8), (2500, [1.0]),
             (None, x[3].tolist()), rows[0]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("ID", ann.F.lit(1))
    got = {}
    for r in ann.search(df, lambda i: i % 100 == 0, cell_rows=16).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    good = {i: np.array(v) for i, v in rows if i is not None and i < 2000}
    ids = np.array(sorted(good))
    m = np.array([good[i] for i in ids])
    assert sorted(got) == [i for i in ids if i % 100 == 0]
    hit = 0
    for q, found in got.items():
        found.sort()
        d = np.sqrt(((m - good[q]) ** 2).sum(1))
        true = [int(ids[j]) for j in np.lexsort((ids, d)) if ids[j] != q][:10]
        assert [f[0] for f in found] == list(range(1, 11))
        assert all(abs(f[2] - np.sqrt(((good[f[1]] - good[q]) ** 2).sum())) < 1e-12 for f in found)
        hit += len(set(true) & {f[1] for f in found})
    assert hit >= 0.9 * 10 * len(got)
    assert [f[1] for f in got[100]] == list(range(1000, 1010))
    assert ann.search(df.limit(0), lambda i: i % 100 == 0).count() == 0
    few = ann.search(df.filter("vec_id < 4"), lambda i: i == 0).collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3]


# registration ----------------------------------------------------------------------------------------
def test_registered():
    import __spark_entry__ as e
    import corpus_pipeline
    names = [n for n in e.queries() if n.startswith("op")]
    assert {int(n[2:].split("_")[0]) for n in names} == set(range(1, 14)) and "pipeline" in e.queries()
    assert len(corpus_pipeline.STAGES) == 5


def test_pipeline_stages(spark, docs):
    import corpus_pipeline
    d, kept = docs.drop("TEXT_LEN", "a b"), None
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        d = stage(spark, d, "")
        assert i == 4 or d.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if i == 0:
            kept = {r.doc_id for r in d.collect()}
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        none = stage(spark, docs.drop("TEXT_LEN", "a b").limit(0), "")
        assert none.count() == 0 and (i == 4 or none.columns == ["doc_id", "text", "lang", "source", "n_chars"])
    rows = d.collect()
    assert rows and {r.doc_id for r in rows} <= kept and all(r.n_pieces == len(r.ids) for r in rows)
