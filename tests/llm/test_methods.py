"""The operators' own parts against plain versions."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkwright.llm import lines, passages, pieces, pii, quality, simhash, toxicity
from sparkwright.llm.common import table
from sparkwright.llm.components import components
from sparkwright.llm.exact_dedup import QuotientFilter, repeated_prints
from sparkwright.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_ORACLE, SF_SMALL
from tools.oracle_check import compare


@given(st.lists(st.lists(st.integers(0, (1 << 52) - 1) | st.integers(0, 9), max_size=30), min_size=1, max_size=5))
@settings(max_examples=60, deadline=None)
def test_quotient_filters_merge_losslessly(parts):
    filters = []
    for part in parts:
        prints, counts = np.unique(np.array(part, np.uint64), return_counts=True)
        filters.append(QuotientFilter.from_bytes(QuotientFilter.of(prints, counts, 0, 1 << 20).to_bytes()))
    got = QuotientFilter.merged(filters, 0).items(0)
    expected = np.unique(np.array([x for p in parts for x in p], np.uint64), return_counts=True)
    assert (got[0] == expected[0]).all() and (got[1] == expected[1]).all()


def test_repeated_prints(spark):
    draw = random.Random(1)
    values = [draw.getrandbits(52) for _ in range(500)]
    values += values[:40] + [values[0]] * 300
    df = spark.createDataFrame([(v,) for v in values], "print long").repartition(5)
    got = {(r["print"], r["n"]) for r in repeated_prints(df).collect()}
    assert got == {(v, values.count(v)) for v in set(values) if values.count(v) > 1}


def test_near_groups_find_all_links(spark):
    draw = random.Random(2)
    prints = [draw.getrandbits(64) for _ in range(300)]
    for p in prints[:60]:
        prints.append(p ^ sum(1 << b for b in draw.sample(range(64), draw.choice([1, 3, 4, 5]))))
    centre = draw.getrandbits(64)  # a large shard
    prints += [centre ^ (1 << draw.randrange(24) | 1 << draw.randrange(24)) for _ in range(300)]
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = {r["print"]: r["root"] for r in simhash.near_groups(spark.createDataFrame([(p,) for p in signed], "print long")).collect()}
    group = list(range(len(prints)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                group[root(i)] = root(j)
    least = {}
    for i, s in enumerate(signed):
        least[root(i)] = min(least.get(root(i), s), s)
    assert {s: got.get(s, s) for s in signed} == {s: least[root(i)] for i, s in enumerate(signed)}


def test_components_of_a_path_and_a_star(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(5, k) for k in range(6, 90)] + [(3, 3), (None, 4)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 100 for k in range(101, 161)}, **{k: 5 for k in range(6, 90)}}


@given(st.lists(st.integers(0, 3), max_size=12), st.lists(st.integers(0, 3), max_size=12), st.integers(0, 12))
@settings(max_examples=200, deadline=None)
def test_edits(a, b, most):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    assert lines.edits(a, b, most) == min(row[-1], most + 1)


def test_large_candidate_groups_are_dealt_by_block(spark, monkeypatch):
    draw = random.Random(4)
    base = [f"word{draw.randrange(10 ** 6)}" for _ in range(60)]
    texts = [" ".join(base[:k] + [f"new{k}"] + base[k + 1:]) for k in range(0, 60, 2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = sorted(tuple(r) for r in lines.dedup_lines(docs).collect())
    monkeypatch.setattr(lines, "TOGETHER", 3)
    assert sorted(tuple(r) for r in lines.dedup_lines(docs).collect()) == whole == sorted(lines.brute_force(list(enumerate(texts))))
    assert sum(r[3] for r in whole) > 0


def edited(draw, line, n):
    own = list(line)
    for _ in range(n):
        at, c = draw.randrange(len(own)), draw.choice("abcdefghijklmnopqrstuvwxyz")
        own[at:at + draw.randrange(2)] = [c] if draw.randrange(3) else []
    return "".join(own)


def test_gram_counts_never_rule_out_like_lines():
    draw = random.Random(9)
    for n in list(range(1, 60)) + [300, 900]:
        a = "".join(draw.choice("abcdefgh  é") for _ in range(n))
        b = edited(draw, a, draw.randrange(0, n // 8 + 2))
        e = lines.edits(a, b, 10 ** 6) if a != b else 0
        for width, bins in ((2, 128), (3, 1024)):
            counts = lines.gram_counts([a, b, ""], width, bins)
            assert lines.apart(counts, np.array([1]), 0)[0] <= 2 * width * e
            assert counts[0].sum() == max(0, n - width + 1) and not counts[2].any()


def test_like_lines_are_found_by_edit_similarity_alone(spark):
    draw = random.Random(6)
    word = lambda: "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randrange(2, 9)))
    texts = []
    for n in (2, 3, 5, 10, 15, 20, 40, 60):  # words of a line; a word in ten changed, one typo, and typos up to the limit
        for _ in range(4):
            own = [word() for _ in range(n)]
            changed = list(own)
            for k in draw.sample(range(n), n // 10):
                changed[k] = word()
            line = " ".join(own)
            texts += [line, " ".join(changed), edited(draw, line, 1), edited(draw, line, len(line) // 12)]
    rows = list(enumerate(texts))
    got = sorted(tuple(r) for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect())
    assert got == sorted(lines.brute_force(rows))
    assert sum(r[3] for r in got) > 70


def test_candidates_of_like_lines():
    draw = random.Random(8)
    base = ["".join(draw.choice("abcdefgh  ") for _ in range(n)) for n in range(12, 212)]
    pairs = [(a, b) for a in base for b in (edited(draw, a, 1), edited(draw, a, len(a) // 10)) if a != b and lines.similar(a, b, 0.9)]
    row, hashes, marks = lines.gram_rows([x for p in pairs for x in p], range(lines.GRAMS), 0.9)
    found = set()
    for h in np.unique(hashes):
        own = np.flatnonzero(hashes == h)
        found |= {row[i] // 2 for i in own for j in own if row[i] + 1 == row[j] and row[i] % 2 == 0 and lines.alike(marks[[i]], marks[[j]], 0.9)[0]}
    assert len(found) >= 0.98 * len(pairs) > 300


def test_marks_tell_lines_of_one_vocabulary_apart():
    draw = random.Random(12)
    words = ["".join(draw.choice("the on an ti re ing sh ou er ble ha nd st in en".split()) for _ in range(draw.randrange(1, 5))) for _ in range(3000)]
    texts = list(dict.fromkeys(" ".join(draw.choice(words) for _ in range(draw.randrange(10, 120))) for _ in range(400)))
    row, hashes, marks = lines.gram_rows(texts, range(lines.GRAMS), 0.9)
    sets, nodes = lines.candidate_sets(hashes, row.astype(np.int64), marks, 0.9)
    assert len(set(nodes.tolist())) < 40  # of 400, none like another
    changed = [edited(draw, t, len(t) // 12) for t in texts[:200]]
    row, hashes, marks = lines.gram_rows([x for p in zip(texts, changed, strict=False) for x in p], range(lines.GRAMS), 0.9)
    sets, nodes = lines.candidate_sets(hashes, row.astype(np.int64), marks, 0.9)
    own = {}
    for s, k in zip(sets.tolist(), nodes.tolist(), strict=True):
        own.setdefault(s, set()).add(k)
    found = {k // 2 for some in own.values() for k in some if k ^ 1 in some}
    like = [k for k in range(200) if lines.similar(texts[k], changed[k], 0.9)]
    assert len(like) > 150 and len(found & set(like)) >= 0.98 * len(like)


def test_line_groups_beyond_one_comparison(spark, monkeypatch):
    draw = random.Random(13)
    base = " ".join(f"word{draw.randrange(10 ** 6)}" for _ in range(30))
    texts = [edited(draw, base, draw.randrange(1, 8)) for _ in range(30)] + [base, base.upper(), "short", "shorter line"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = sorted(lines.brute_force(list(enumerate(texts))))
    for few, pairs, rows in ((256, 7, 50), (3, 30_000, 60_000)):
        for name, value in (("FEW", few), ("PAIRS", pairs), ("ROWS", rows)):
            monkeypatch.setattr(lines, name, value)
        assert sorted(tuple(r) for r in lines.dedup_lines(docs).collect()) == whole


def test_compact_windows_hold_each_subsequence_once():
    draw = np.random.default_rng(1)
    values = np.concatenate([draw.integers(0, 1 << 62, 300), np.full(200, 7 << 40), draw.integers(0, 5, 150) << 40]).astype(np.uint64)
    first = np.array([0, 300, 500, 650])
    lo, c, hi = passages.compact_windows(values, first, 10)
    for a, b in zip(first[:-1], first[1:], strict=True):
        for i in range(a, b - 9, 7):
            for j in range(i + 9, b, 11):
                own = np.flatnonzero((lo <= i) & (i <= c) & (c <= j) & (j <= hi))
                assert len(own) == 1 and values[c[own[0]]] == values[i:j + 1].min()


def test_planted_passages(spark):
    draw = random.Random(3)
    text = lambda n: " ".join(f"w{draw.randrange(5000)}" for _ in range(n))
    common, other, near = text(60), text(52), text(80).split()
    changed = list(near)
    changed[30] = "changed"
    rows = [(1, f"{text(100)} {common} {text(70)}"), (2, f"{common} {text(30)}"), (3, f"{text(500)} {other}"), (4, f"{other} {text(20)}"),
            (5, f"{text(40)} {' '.join(near)}"), (6, f"{' '.join(changed)} {text(100)}"), (7, text(300)), (8, text(45))]
    rows += [(100 + k, f"{text(60)} {common} {text(60)}") for k in range(40)]
    found = {r["doc_id"]: r for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert set(found) == {i for i, _ in rows} - {7, 8}
    assert [tuple(p) for p in found[1]["passages"]] == [(100, 160)] and found[105]["class_id"] == 1 and found[6]["class_id"] == 5
    assert found[4]["passages"][0]["start"] == 0 and found[4]["n_repeated"] == 52


def test_a_change_at_any_place_of_a_short_passage():
    draw = np.random.default_rng(5)
    for n in range(50, 61):  # words; a changed word changes up to five shingles
        for place in range(n):
            for around in (0, 9):
                a = draw.integers(0, 1 << 62, n - 4 + 2 * around).astype(np.uint64)
                b = a.copy()
                gone = np.arange(max(0, place - 4), min(n - 4, place + 1)) + around
                b[gone] = draw.integers(0, 1 << 62, len(gone))
                b[:around], b[len(b) - around:] = draw.integers(0, 1 << 62, around), draw.integers(0, 1 << 62, around)
                found = passages.stretch(a, b, 0, 0, 46, 0.8)
                share = (n - 4 - len(gone)) / (n - 4 + len(gone))
                assert found or share < 0.8, (n, place, around)
                if found:
                    x, y = set(a[found[0]:found[1]].tolist()), set(b[found[2]:found[3]].tolist())
                    assert min(len(x), len(y)) >= 46 and len(x & y) / len(x | y) == found[4] >= 0.8


def test_passages_that_earlier_documents_quote_in_part():
    """Two documents share 60 words of which 20 earlier ones quote 40 (too few for a passage): joined in 92, 95, 97 and
    99 of 100 runs by 4, 5, 6 and 8 hash functions."""
    draw, rows = random.Random(11), []
    text = lambda n: [f"w{draw.randrange(10 ** 6)}" for _ in range(n)]
    for run in range(100):
        whole = text(60)
        starts = [(at := draw.randrange(21), " ".join(text(20) + whole[at:at + 40] + text(20))) for _ in range(20)]
        rows += [x for _, x in starts] + [" ".join(text(20) + whole + text(20)) for _ in range(2)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array(rows)], ["id", "text"])
    windows = pa.Table.from_batches(list(passages.window_rows(passages.HASHES, 46)(iter([batch]))))
    dealt = windows.sort_by([("key", "ascending"), ("doc", "ascending")]).combine_chunks().to_batches()
    places = {}
    for x in pa.Table.from_batches(list(passages.join_windows(iter(dealt)))).to_pylist():
        places.setdefault((x["doc"], x["a_doc"]), []).append((x["place"], x["a_place"]))
    tokens = [next(passages.shingles(data, off)[0] for _, _, data, off in passages.slices(pa.array([x]))) for x in rows]
    joined = [k for k in range(100) if passages.verified(tokens[22 * k + 20], tokens[22 * k + 21], places.get((22 * k + 21, 22 * k + 20), []), 46, 0.8)]
    assert len(joined) >= 94


def test_no_copied_passage_is_lost_to_representatives_that_lack_it():
    """Two documents share 50 or 60 words of which 30 earlier ones hold 40 or 44 (too few for a passage), some of them from
    the document's first word on."""
    draw = random.Random(12)
    text = lambda n: [f"w{draw.randrange(10 ** 6)}" for _ in range(n)]
    for size, part, around in ((50, 40, 20), (50, 44, 20), (60, 40, 0)):
        rows = []
        for _ in range(30):
            whole = text(size)
            starts = [draw.randrange(size - part + 1) for _ in range(30)]
            rows += [" ".join(text(around) + whole[at:at + part] + text(20)) for at in starts]
            rows += [" ".join(text(around) + whole + text(20)) for _ in range(2)]
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array(rows)], ["id", "text"])
        windows = pa.Table.from_batches(list(passages.window_rows(passages.HASHES, 46)(iter([batch]))))
        dealt = windows.sort_by([("key", "ascending"), ("doc", "ascending")]).combine_chunks().to_batches()
        places = {}
        for x in pa.Table.from_batches(list(passages.join_windows(iter(dealt)))).to_pylist():
            places.setdefault((x["doc"], x["a_doc"]), []).append((x["place"], x["a_place"]))
        tokens = passages.tokens(pa.array(rows))
        for k in range(31, len(rows), 32):
            assert passages.verified(tokens[k - 1], tokens[k], places.get((k, k - 1), []), 46, 0.8), (size, part, around, k)


def test_an_equal_run_that_makes_a_passage_is_one_with_any_representative():
    """A run of ``sure`` tokens about which one document goes on before and the other behind is verified."""
    for least, similarity in ((46, 0.8), (26, 0.8), (46, 0.9)):
        enough = passages.sure(least, similarity)
        assert all(any(x >= l and least - 1 - x >= r for l, r in passages.run_sides(least, similarity)) for x in range(least))  # noqa: E741
        draw = np.random.default_rng(7)
        run, more = draw.integers(0, 1 << 62, enough).astype(np.uint64), [draw.integers(0, 1 << 62, 9).astype(np.uint64) for _ in range(2)]
        a, b = np.concatenate([more[0], run]), np.concatenate([run, more[1]])
        # The first's window begins before the run, the second's ends behind it.
        assert passages.verified(a, b, [(0 << 32 | least - 1, 9 << 32 | (least - enough) << 16 | enough - 1)], least, similarity)


def test_lattice_is_the_best_path(spark):
    model, byte_ids, _ = pieces.load_pieces()
    cost = {p: (c, k) for p, k, c in model}
    unknown, longest = max(c for _, _, c in model) + 1, max(map(len, cost))
    own = [" the", " unbelievable", "zzqx", " ", "日本", " a▁b", " é", " \x00x", "internationalization", " ß" * 3]
    got = {r["word"]: r["ids"] for r in pieces.best_paths(spark.createDataFrame([(1, w) for w in own], "chunk int, word string"), ["chunk"], model, byte_ids).collect()}
    price = {k: c for _, k, c in model}
    for word in own:
        best = [0] + [None] * len(word)
        for j in range(1, len(word) + 1):
            ways = [best[i] + cost[word[i:j]][0] for i in range(max(0, j - longest), j) if word[i:j] in cost]
            best[j] = min([*ways, best[j - 1] + unknown])
        spent, pending = 0, 0
        for k in got[word]:
            if k in price:
                spent += price[k]
            else:
                pending += 1
        missing = [c for c in word if c not in cost]
        assert spent + unknown * len(missing) >= best[-1] - unknown and (pending or spent == best[-1])


def test_whole_texts_take_the_cheapest_path(spark):
    """Against a plain Viterbi over whole texts, without any words."""
    model, byte_ids, _ = pieces.load_pieces()
    table = {p: (k, c) for p, k, c in model}
    longest, unknown = max(map(len, table)), max(c for _, _, c in model) + 1
    texts = ["He said “yes.” Then left.", "He went home (†1921).", "        if x:  # indented\n\t\treturn  y", "a_very_long_identifier_name_of_code_" * 20, "x" * 700, "...---...!!!!????", "«oui», »non«,”",
             "1234567890 12.5%", "Привет, мир! 数据 获取 😀😀", " lead and trail  ", "https://example.org/a?b=c&d=%20e", "A▁B", "e\u0301e\u0301", "tab\tnew\r\nline", "", " "]
    texts += [r["text"] for r in table_rows(spark, "documents", 40) if r["text"]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["pieces"] for r in pieces.encode(docs).collect()}
    for k, text in enumerate(texts):
        assert got[k] == (pieces.best_path(" " + text, table, longest, unknown, byte_ids) if text else []), text[:80]


def table_rows(spark, name, n):
    return table(spark, SF_SMALL, name).orderBy("doc_id").limit(n).collect()


def test_cuts_lie_where_no_piece_can(spark):
    import re
    model, _, _ = pieces.load_pieces()
    pattern = re.compile(pieces.cuts(model))
    for surface, _, _ in model:
        assert pattern.fullmatch(surface), surface
    assert pieces.cuts([("a b", 1, 1)]) == r"[\s\S]+"


def test_a_loop_finds_what_the_lattice_finds(spark):
    model, byte_ids, _ = pieces.load_pieces()
    table_ = {p: (k, c) for p, k, c in model}
    longest, unknown = max(map(len, table_)), max(c for _, _, c in model) + 1
    draw = random.Random(2)
    own = sorted({"".join(draw.choice("abcdeinorstu  ,.é数☃") for _ in range(draw.randrange(1, 33))) for _ in range(300)})
    got = {r["word"]: r["ids"] for r in pieces.best_paths(spark.createDataFrame([(w,) for w in own], "word string"), [], model, byte_ids).collect()}
    assert got == {w: pieces.best_path(w, table_, longest, unknown, byte_ids) for w in own}


def test_disguised_words_are_restored():
    words = "idiot stupid loser scum moron worthless trash pathetic disgusting clown river stone market".split()
    a, b, c = toxicity.trigrams("\n".join(words * 50))
    decoder = toxicity.Decoder(np.bincount(toxicity.tri_bucket(a, b, c), minlength=toxicity.TRI).astype(float),
                               np.bincount(toxicity.bi_bucket(a, b), minlength=toxicity.BI).astype(float))
    for seen, meant in {"1d10t": "idiot", "$tup1d": "stupid", "l0ser!!": "loser", "scuuum": "scum", "w0rthl3ss": "worthless", "p@thet1c": "pathetic",
                        "d1sgust!ng": "disgusting", "cl*wn": "clown", "st.u.p.i.d": "stupid", "***scum***": "scum"}.items():
        assert meant in decoder.words(seen), seen
    assert {"idiot", "moron", "trash"} <= set(decoder.text_words("you i d i o t and m 0 r 0 n, t-r-a-s-h"))


def test_terms_that_reveal_an_entity(spark):
    rows = [(k, f"Agent Zorblax wrote from spy@corp.example.org about {topic} of the day") for k, topic in enumerate(("alpha", "beta", "gamma", "delta"))]
    rows += [(100 + k, f"the day of the agent and what he wrote about {k}") for k in range(400)]
    found = {r["doc_id"]: r for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    terms = {s["value"] for s in found[0]["spans"] if s["kind"] == "term"}
    assert "Zorblax" in terms and not terms & {"the", "of", "day", "wrote"}
    assert "Zorblax" not in found[0]["sanitised"] and "[EMAIL]" in found[0]["sanitised"]
    assert not found[100]["spans"]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    assert compare(spark, SF_SMALL, [name], verbose=False)[name][0] == "OK"


def test_held_out_accuracy(spark):
    labels = table(spark, SF_ORACLE, "labels")
    found = QUERIES["op6_quality"](spark, SF_ORACLE).join(labels, "doc_id").where("held_out")
    assert found.where("predicted = quality").count() > 0.95 * found.count()
    found = QUERIES["op8_toxicity"](spark, SF_ORACLE).join(labels, "doc_id").where("held_out")
    clean = found.where("toxic = 0")
    assert clean.where("predicted = 1").count() <= 0.05 * clean.count()
    docs = table(spark, SF_ORACLE, "documents").select("doc_id", "lang")
    found = QUERIES["op4_language_id"](spark, SF_ORACLE).join(docs, "doc_id").where("held_out")
    assert found.where(F.col("lang") == F.col("lang_pred")).count() > 0.97 * found.count()


def test_attention_weights_sum_to_one(spark):
    found = quality.quality(table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels"))
    sums = found.select(F.aggregate("attention", F.lit(0.0), lambda t, a: t + a).alias("s")).collect()
    assert all(abs(r["s"] - 1) < 1e-4 for r in sums)


def test_edges_are_folded_across_blocks(monkeypatch):
    model, byte_ids, _ = pieces.load_pieces()
    table_, longest, unknown = {p: (k, c) for p, k, c in model}, max(len(p) for p, _, _ in model), max(c for _, _, c in model) + 1
    own = [" the", "a", " international", "naïve", "数据获取", "😀😀x", " " * 9, "x" * pieces.WORD, "qzxjv"]
    rows = []
    for k, w in enumerate(own):
        for start in range(len(w)):
            for end in range(start + 1, min(len(w), start + longest) + 1):
                id_, cost = table_.get(w[start:end], (pieces.NO_PIECE, unknown))
                if id_ != pieces.NO_PIECE or end == start + 1:
                    head = (start, end) == (0, 1)
                    rows.append((k if head else None, w if head else None,
                                 end << pieces.COST_BITS + pieces.LOW | cost << pieces.LOW | start << pieces.ID_BITS | id_))
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.string(), pa.int64()), strict=True)],
                                       ["chunk", "word", "edge"])
    for edges, step in ((10 ** 6, len(rows)), (20, 7), (1, 1), (50, 1000)):
        monkeypatch.setattr(pieces, "EDGES", edges)
        got = [r for b in pieces.folded(byte_ids)(iter(batch.slice(i, step) for i in range(0, len(rows), step))) for r in b.to_pylist()]
        assert [(r["chunk"], r["word"], r["ids"]) for r in got] == [(k, w, pieces.best_path(w, table_, longest, unknown, byte_ids)) for k, w in enumerate(own)]


def test_texts_and_words_travel_packed(spark):
    """A text reaches its chunk compressed, a word as its pieces alone; both come back whole."""
    import re
    model, byte_ids, raw = pieces.load_pieces()
    pattern = pieces.cuts(model)
    draw = random.Random(4)
    vocabulary = ["".join(draw.choice("abcdeinorstu") for _ in range(draw.randrange(2, 10))) for _ in range(2000)]
    texts = [" ".join(draw.choices(vocabulary, k=400)) for _ in range(1000)] + [None, "", "naïve 数据 😀 ☃x", "word " * 200_000]
    docs = spark.createDataFrame([(None if k % 50 == 0 else k // 2, t) for k, t in enumerate(texts)], "id long, text string").repartition(3)
    sent = docs.mapInArrow(pieces.packed(5), "chunk int, rows binary").collect()
    assert sum(len(r["rows"]) for r in sent) < 0.55 * sum(len((t or "").encode()) for t in texts)
    assert {r["chunk"] for r in sent} == set(range(5))
    back = [tuple(x.values()) for r in sent for x in pieces.unpacked(pa.scalar(bytes(r["rows"]), pa.binary())).to_pylist()]
    assert sorted(back, key=repr) == sorted((tuple(r) for r in docs.collect()), key=repr)
    batch = pa.RecordBatch.from_arrays([pa.array([r["chunk"] for r in sent], pa.int32()), pa.array([bytes(r["rows"]) for r in sent], pa.binary())], ["chunk", "rows"])
    got = {w for b in pieces.packed_words(pattern)(iter([batch])) for w in b.column("word").to_pylist()}
    own = sorted({w for t in texts if t is not None for w in re.findall(pattern, " " + t) if len(w) <= pieces.WORD})
    assert got == set(own)
    table_, longest, unknown = {p: (k, c) for p, k, c in model}, max(len(p) for p, _, _ in model), max(c for _, _, c in model) + 1
    ids = pa.array([pieces.best_path(w, table_, longest, unknown, byte_ids) for w in own], pa.list_(pa.int32()))
    assert pieces.spelled_words(ids, pa.array(raw, pa.binary())) == own
    assert pieces.spelled_words(ids.slice(7, 90), pa.array(raw, pa.binary())) == own[7:97]
    assert pieces.spelled_words(ids[:0], pa.array(raw, pa.binary())) == []


def test_rounds_leave_no_shuffle_files(tmp_dir):
    """In a session of its own, that never deletes shuffle files for want of references."""
    import os
    import subprocess
    import sys
    code = """
import os, sys, time
from sparkwright.llm import common, lines
from sparkwright.session import build_session
top = sys.argv[1]
spark = build_session("local[2]", 4, "clean-up", {"spark.local.dir": top + "/local", "spark.cleaner.referenceTracking": "false"})
spark.sparkContext.setCheckpointDir(top + "/shared")
def left(n):
    end = time.time() + (15 if n >= 0 else 0)
    while (now := sum(x.startswith("shuffle_") for _, _, names in os.walk(top + "/local") for x in names)) != n and time.time() < end:
        time.sleep(0.1)
    return now
before = spark.conf.get(common.CLEAN_UP)
common.written(spark.range(1000).repartition(3, "id"), "kept")
kept = left(-1)
held = spark.range(1000).repartition(5, "id")
rows = len(common.written(held, "gone", clean_up=True).collect())
after = left(kept)
texts = spark.createDataFrame([("the quick brown fox jumps over the lazy dog %d" % (k % 7),) for k in range(60)], "text string")
links = len(lines.like_lines(texts, 0.9).collect())
print("LEFT", kept > 0, rows, after == kept, links, left(kept) == kept, spark.conf.get(common.CLEAN_UP) == before)
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    run = subprocess.run([sys.executable, "-c", code, tmp_dir], cwd=root, env=os.environ | {"PYTHONPATH": root}, capture_output=True, text=True, timeout=300)
    assert "LEFT True 1000 True 6 True True" in run.stdout, run.stdout + run.stderr[-2000:]


def quoted(draw: random.Random, times: int) -> list[str]:
    """Texts by 22: twenty that hold 40 words of one passage, and two that hold all 60, the last with one word changed."""
    text = lambda n: [f"w{draw.randrange(10 ** 6)}" for _ in range(n)]
    rows = []
    for _ in range(times):
        whole = text(60)
        for _ in range(20):
            at = draw.randrange(21)
            rows.append(" ".join(text(20) + whole[at:at + 40] + text(20)))
        changed = list(whole)
        changed[draw.randrange(60)] = "changed"
        rows += [" ".join(text(20) + x + text(20)) for x in (whole, changed)]
    return rows


def test_edited_passages_meet_whatever_representatives_lack(spark):
    """Of the pairs that share an edited passage all are linked, though the first documents with their min-hashes hold but parts."""
    rows = quoted(random.Random(21), 60)
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    found = {(r["a_doc"], r["doc"]) for r in passages.passage_links(docs).collect()}
    assert all((22 * k + 20, 22 * k + 21) in found for k in range(60))


def test_contexts_that_can_make_a_passage_are_paired():
    """Against all pairs, in one large key; what is in passages of one group already is left out."""
    draw = np.random.default_rng(5)
    part = draw.integers(0, 1 << 24, 38)
    rows = [np.concatenate([draw.integers(0, 1 << 24, 20), part, draw.integers(0, 1 << 24, 30)]) for _ in range(120)]
    for k in range(0, 120, 3):  # a copy with five tokens changed
        rows.append(np.where((np.arange(88) >= 60) & (np.arange(88) < 65), draw.integers(0, 1 << 24, 88), rows[k]))
    codes = pa.array([x.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes() for x in rows], pa.binary())
    n = len(rows)
    doc, root, told = np.arange(n), np.arange(n), np.zeros(n, bool)
    wanted = {(i, j) for i in range(n) for j in range(i + 1, n) if len(np.intersect1d(rows[i], rows[j])) >= 41}
    pairs, twice = passages.context_pairs(np.zeros(n, np.int64), doc, root, told, codes, 46, 0.8)
    assert set(map(tuple, pairs.tolist())) == wanted == {(3 * k, 120 + k) for k in range(40)} and not twice.any()
    root[120:] = np.arange(0, 120, 3)
    assert not len(passages.context_pairs(np.zeros(n, np.int64), doc, root, ~told, codes, 46, 0.8)[0])
    assert len(passages.context_pairs(np.zeros(n, np.int64), doc, root, told, codes, 46, 0.8)[0]) == 40


def test_pieces_follow_what_the_candidate_sets_hold(spark, monkeypatch):
    """Twenty sets of two lines of 100 characters are 4,000 characters."""
    sets = spark.createDataFrame([(k // 2, 0, k % 2, 2) for k in range(40)], "lead long, deal long, node long, n long")
    bodies = spark.createDataFrame([(k, "x" * 100) for k in range(2)], "node long, body string")
    assert lines.pieces_of(sets, bodies, 8) == 2 == lines.pieces_of(sets.where("false"), bodies, 8)
    monkeypatch.setattr(lines, "PIECE", 100)
    assert lines.pieces_of(sets, bodies, 8) == 5
    monkeypatch.setattr(lines, "TOGETHER", 1)
    assert lines.pieces_of(sets, bodies, 8) == 200
