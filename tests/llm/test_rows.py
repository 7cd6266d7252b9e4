"""Operators that judge row by row: quality, personal data, encoding, toxicity."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillframe.llm import common, pieces, pii, quality, queries, toxicity
from tests.llm import helpers

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_quality(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated, len(covered)


@pytest.mark.parametrize("most", [1, 2 << 20])
def test_quality_counts(spark, most):
    texts = [r["text"] for r in helpers.awkward(spark).collect()] + [helpers.prose(1) + "\n" + helpers.prose(1), "a\x0b\x85b #$é é", "x y z u v " * 30, "é\n\né"]
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    found = quality.measure(pa.array(texts)) if most > 1 else None
    for i, t in enumerate(texts):
        one = quality.measure(pa.array([t])) if found is None else {k: v[i : i + 1] for k, v in found.items()}
        assert tuple(int(one[n][0]) for n in names) == brute_quality(t)


def test_quality_survives_hash_collisions(monkeypatch):
    text = helpers.prose(3, 400) + " " + helpers.prose(3, 400)
    want = {k: v.tolist() for k, v in quality.measure(pa.array([text, "other " + text])).items()}
    monkeypatch.setattr(quality.common, "mixed", lambda x, seed=0: (x % 7).astype("uint64"))
    assert {k: v.tolist() for k, v in quality.measure(pa.array([text, "other " + text])).items()} == want


def test_quality_stage(spark):
    rows = helpers.clashing(helpers.awkward(spark).union(helpers.docs(spark, "same line of words here\n" * 20, first=50)), "kept", "n_words")
    out = quality.rejected_out(rows)
    assert out.columns == rows.columns
    kept = Counter(r["doc_id"] for r in out.collect())
    assert kept == {1: 1, 6: 2, 7: 1, None: 1, 8: 1}
    assert out.first()["kept"] == "mine"
    assert quality.rejected_out(helpers.empty(spark)).count() == 0


def luhn(digits):
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits[::-1])) % 10 == 0


def brute_pii(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


PII = ["a@b.c d@e", "a@b.c_x@y.zz", "1.2.3.4.5.6.7.8", "0001.2.3.4", "999.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "call +1 (743) 555-3824.", "+1 2", "😀 +4915112345678 é a.b%c@x-y.org", "x\x01a@b.c\x01", "GB82 WEST 1234 5698 7654 32", "ssn 123-45-6789", "123-45-6789", None, "", "1.2.3.4 " * 700, "a" * 3000, "9" * 3000]


def test_pii_base_spans(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(PII)], "doc_id int, text string")
    base = pii.joined(F.filter("spans", lambda s: s["kind_no"] < len(pii.BASE_KINDS)))
    found = {r[0]: r[1] for r in pii.with_spans(rows).select("doc_id", base).collect()}
    assert found == {i: brute_pii(t) for i, t in enumerate(PII)}


def test_pii_checksums_and_context(spark):
    rows = spark.createDataFrame([(t,) for t in ("GB82 WEST 1234 5698 7654 32", "GB82 WEST 1234 5698 7654 33", "ssn 123-45-6789", "123-45-6789", "login 8.8.8.8", "version 8.8.8.8")], "text string")
    found = [[(s["kind"], s["score"]) for s in r["spans"]] for r in pii.with_spans(rows).select("spans").collect()]
    assert found == [[("iban", 0.9)], [], [("ssn", 0.6)], [], [("ip", 0.9)], [("ip", 0.3)]]


def test_pii_context_reaches_over_other_matches(spark):
    texts = ["SSN: 123-45-6789, 219-09-9999", "123-45-6789 219-09-9999 are SSN", "SSN: 123-45-6789" + " " * 30 + "219-09-9999", "host " + "1.1.1.1 " * 6]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r["doc_id"]: [(s["start"], s["score"]) for s in r["spans"]] for r in pii.with_spans(rows).collect()}
    assert found == {0: [(5, 0.6), (18, 0.6)], 1: [(0, 0.6), (12, 0.6)], 2: [(5, 0.6)], 3: [(5 + 8 * k, 0.9 if k < 5 else 0.6) for k in range(6)]}
    assert pii.masked_out(helpers.docs(spark, texts[0])).first()["text"] == "SSN: [SSN], [SSN]"


def test_pii_ibans_before_upper_case_words(spark):
    be, at, es, gb = "BE68 5390 0754 7034", "AT61 1904 3002 3457 3201", "ES9121000418450200051332", "GB82 WEST 1234 5698 7654 32"
    texts = [f"IBAN {be} BIC KREDBEBB", f"{at} BIC X", f"{es} BIC", f"{gb} SWIFT ABNA", f"{be} {at} {es}", f"{be[:-1]}5 BIC", f"{es}BIC", f"é {at}. {es},"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r["doc_id"]: [texts[r["doc_id"]][s["start"] : s["end"]] for s in r["spans"] if s["kind"] == "iban"] for r in pii.with_spans(rows).collect()}
    assert found == {0: [be], 1: [at], 2: [es], 3: [gb], 4: [be, at, es], 5: [], 6: [], 7: [at, es]}
    assert pii.masked_out(helpers.docs(spark, texts[0])).first()["text"] == "IBAN [IBAN] BIC KREDBEBB"


def test_pii_stage(spark):
    rows = helpers.clashing(helpers.awkward(spark).union(helpers.docs(spark, "mail me@x.org or 4111111111111111 now", "é +1 (743) 555-3824", first=50)), "spans", "score")
    out = {(r["doc_id"], r["text"]): r for r in pii.masked_out(rows).collect()}
    assert (50, "mail [EMAIL] or [CARD] now") in out and (51, "é [PHONE]") in out and (2, None) in out
    assert out[51, "é [PHONE]"]["n_chars"] == 9 and out[51, "é [PHONE]"]["spans"] == "mine"
    assert pii.masked_out(rows).count() == rows.count() and pii.masked_out(rows).columns == rows.columns
    assert pii.masked_out(helpers.empty(spark)).count() == 0


TEXTS = [None, "", " ", "  two  spaces ", "a\nb\tc", "日本語 テスト", "é😀 naïve", "<s> </s> <unk>", "word" * 200, "-" * 300, " " * 200, "0123 456,7.", "𝔘 ẞ ﬁ"]


def test_encoding_without_dropout_is_the_library_s():
    import sentencepiece

    path = queries.tokenizer_file(queries.PIECE_MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = TEXTS + [helpers.prose(k) for k in range(5)]
    ids, cuts = pieces.Encoder(path)(pa.array(texts), pa.array(range(len(texts))).to_numpy())
    assert [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:])] == [library.encode(t or "") for t in texts]


def test_dropout_is_lossless_keyed_and_varied(spark):
    path = queries.tokenizer_file(queries.PIECE_MODEL)
    texts = [*TEXTS, "literal ▁ mark ▁", *(helpers.prose(k) for k in range(5))]
    keys = pa.array(range(len(texts))).to_numpy()
    encode = pieces.Encoder(path, 0.2, 5)
    ids, cuts = encode(pa.array(texts), keys)
    assert pieces.decoded(encode.model, ids, cuts).to_pylist() == [t or "" for t in texts]
    alone = [encode(pa.array([t]), keys[i : i + 1])[0].tolist() for i, t in enumerate(texts)]
    assert alone == [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:])]
    again = pieces.Encoder(path, 0.2, 6)(pa.array(texts), keys)[0]
    assert len(again) != len(ids) or (again != ids).any()


def test_long_words_take_the_same_path(monkeypatch):
    path = queries.tokenizer_file(queries.PIECE_MODEL)
    texts, keys = pa.array([helpers.prose(4), "x" * 90]), pa.array([1, 2]).to_numpy()
    want = pieces.Encoder(path, 0.1, 1)(texts, keys)[0].tolist()
    monkeypatch.setattr(pieces, "LONG", 1)
    assert pieces.Encoder(path, 0.1, 1)(texts, keys)[0].tolist() == want


def test_encoded_rows(spark):
    path = queries.tokenizer_file(queries.PIECE_MODEL)
    rows = helpers.clashing(helpers.awkward(spark), "ids")
    out = pieces.encoded(rows, path, F.xxhash64("doc_id"), "doc_id", "ids")
    assert out.where("NOT __lossless").isEmpty() and out.count() == rows.count()
    back = sorted(r["text"] for r in pieces.decoded_rows(out, path, "doc_id").collect())
    assert back == sorted(r["text"] or "" for r in rows.collect())
    assert pieces.encoded(helpers.empty(spark), path, F.col("doc_id")).count() == 0


def toxic_corpus(spark):
    bad = ("vile", "wretched", "scummy")
    texts = [helpers.prose(k, 40) + (f" you {bad[k % 3]} thing" if k % 4 == 0 else "") for k in range(400)]
    rows = helpers.docs(spark, *texts, first=0)
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(300)], "doc_id long, toxic int")
    return rows, labels


def plain_agenda(m, text, key, rate, seed):
    """Ids by the definition: of all neighbours that may merge and are not skipped, the best and leftmost do, again and again."""
    if not text:
        return []
    whole = [(pieces.MARK, False), *((pieces.MARK if c == " " else c, c == pieces.MARK) for c in text)]
    salt = common.mixed(common.mixed(np.array([key], dtype=np.int64).view(np.uint64)), seed)
    is_mark = [c == pieces.MARK and not literal for c, literal in whole]
    out, at = [], 0
    while at < len(whole):
        end = at + 1
        while end < len(whole) and not (is_mark[end] and not is_mark[end - 1]):
            end += 1
        word = [(-1 if whole[k][1] else int(m.of_point[ord(whole[k][0])]), k, k + 1) for k in range(at, end)]
        while True:
            best = None
            for i, ((a, s, mid), (b, _, e)) in enumerate(zip(word, word[1:])):
                if (a, b) in m.merges and not (rate and pieces._skipped(salt, *(np.array([x], dtype=np.int64) for x in (s, mid, e)), rate)[0]):
                    rank, piece = m.merges[a, b]
                    best = min(best or (rank, i, piece), (rank, i, piece))
            if best is None:
                break
            _, i, piece = best
            word[i : i + 2] = [(piece, word[i][1], word[i + 1][2])]
        for sym, s, e in word:
            out += [sym] if 0 <= sym < len(m.pieces) else [int(m.byte_ids[b]) for c, _ in whole[s:e] for b in c.encode()]
        at = end
    return out


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.5, 1.0])
def test_dropout_against_a_plain_agenda(rate):
    path = queries.tokenizer_file(queries.PIECE_MODEL)
    texts = [helpers.prose(3, 20, 2), "  two  spaces ", "mark ▁ here▁", "Ünïcode 速度 \U0001f600", "long" * 30, "", None, "a", "The tokens of the tokenizers, tokenized"]
    keys = np.arange(len(texts), dtype=np.int64) * 7919 - 3
    ids, cuts = pieces.Encoder(path, rate, 11)(pa.array(texts, pa.string()), keys)
    for k, text in enumerate(texts):
        assert ids[cuts[k] : cuts[k + 1]].tolist() == plain_agenda(pieces.model(path), text, int(keys[k]), rate, 11), text


def test_toxicity_learns_from_its_folds(spark):
    rows, labels = toxic_corpus(spark)
    model = toxicity.trained(rows, labels)
    found = toxicity.scored(rows, model, "doc_id").select("doc_id", "__score", toxicity.held_out(F.col("doc_id")).alias("h")).collect()
    held = [r for r in found if r["h"]]
    right = sum((r["__score"] >= 0.5) == (r["doc_id"] % 4 == 0) for r in held)
    assert len(held) > 50 and right / len(held) >= 0.95
    assert all(0 <= r["__score"] <= 1 for r in found)
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.scored(rows, toxicity.trained(rows, flipped), "doc_id").collect()
    assert {r["doc_id"]: round(r["__score"], 9) for r in again} == {r["doc_id"]: round(r["__score"], 9) for r in found}


def test_risk_against_plain_loops():
    """The corrected risk by a loop over rows, and the step's direction by finite differences of it."""
    rng = np.random.default_rng(5)
    some = [np.sort(rng.choice(6, int(rng.integers(0, 5)), replace=False)).astype("<u2") for _ in range(30)]
    scale = rng.uniform(0.5, 2, 6)
    positive, unlabelled = (toxicity.Sparse([r.tobytes() for r in rows], scale) for rows in (some[:9], some[9:]))
    soft = lambda z: math.log1p(math.exp(-abs(z))) + max(z, 0)
    score = lambda row, theta: sum(theta[j] * scale[j] for j in row.tolist()) + theta[-1]

    def plain(theta, prior):
        as_positive = prior * sum(soft(-score(r, theta)) for r in some[:9]) / 9
        as_negative = sum(soft(score(r, theta)) for r in some[9:]) / 21 - prior * sum(soft(score(r, theta)) for r in some[:9]) / 9
        return as_positive, as_negative

    signs = set()
    for prior, shift in ((0.2, 0.0), (0.5, -1.0), (0.9, 3.0), (0.95, 2.0)):
        theta = rng.normal(size=7) * (2 if shift else 0.3)
        theta[-1] += shift
        a, b, step = toxicity.risk(theta, positive, unlabelled, prior)
        assert np.allclose((a, b), plain(theta, prior))
        signs.add(b < 0)
        objective = lambda t, p=prior, below=b < 0: -plain(t, p)[1] if below else sum(plain(t, p))
        slope = [(objective(theta + e) - objective(theta - e)) / 2e-5 for e in np.eye(7) * 1e-5]
        assert np.allclose(step, slope, atol=1e-5)
    assert signs == {True, False}


def test_feature_counts_cover_all_text(spark):
    texts = [helpers.prose(k) for k in range(40)] + [None, ""]
    got = {r["feature"]: r["n"] for r in toxicity.feature_counts(helpers.docs(spark, *texts)).collect()}
    want = Counter(f for t in texts for f in set(toxicity.features(pa.array([t], pa.string()))[0].tolist()))
    assert got == want
    some = sorted(want)[::7]
    mark = np.zeros(1 << toxicity.BITS, dtype=bool)
    mark[some] = True
    assert {r["feature"]: r["n"] for r in toxicity.feature_counts(helpers.docs(spark, *texts), np.packbits(mark)).collect()} == {f: want[f] for f in some}


def test_toxicity_edges(spark):
    rows, labels = toxic_corpus(spark)
    model = toxicity.trained(rows, labels.union(spark.createDataFrame([(None, 1), (1, None), (0, 0)], labels.schema)))
    odd = helpers.clashing(helpers.awkward(spark), "score", "label")
    out = toxicity.scored(odd, model, "doc_id", "score").collect()
    assert len(out) == odd.count()
    empties = {r["__score"] for r in out if r["doc_id"] in (2, 3, 4)}
    assert len(empties) == 1 and empties.pop() < 0.5
    assert toxicity.trained(rows, labels.limit(0)) is None
    assert {r["__score"] for r in toxicity.scored(rows, None, "doc_id").collect()} == {toxicity.NO_MODEL}
    assert toxicity.scored(helpers.empty(spark), model, "doc_id").count() == 0
    assert toxicity.trained(helpers.empty(spark), labels) is None


def test_query_columns(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.QUERIES["op6_personal_data"](spark, sf)
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    row = got.where("n_email = 0 AND n_ip = 0 AND n_card = 0 AND n_phone = 0").first()
    assert row["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert queries.QUERIES["op1_repetition"](spark, sf).columns[:6] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
