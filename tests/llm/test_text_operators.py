import hashlib
import itertools
import random
import re

import numpy as np
import pytest
import xxhash

from llm_common import AWKWARD, corpus, documents, prose
from recordflow.llm import common
from recordflow.llm.pii import base_spans, entity_of, outside, personal_spans, sanitise, sanitised, span_report
from recordflow.llm.quality import failing_rule, keep_clean, line_quality, repeated_words, split_lines
from recordflow.llm.shingles import word_hashes
from recordflow.llm.substring import repeated_spans, units, without, without_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# -- quality -------------------------------------------------------------------


def brute_quality(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    counts = {}
    for w in windows:
        counts[w] = counts.get(w, 0) + 1
    covered = {k + i for k, w in enumerate(windows) if counts[w] > 1 for i in range(8)}
    lines, repeated = [], 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in lines
            lines.append(line)
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered), failed


def test_quality_figures(spark):
    twice = " ".join(prose(5, 30))
    rows = corpus(3, 12) + AWKWARD[:4] + [(950, twice + "\n" + twice + "\nx # $ <é>\nx # $ <é>"), (951, "ab ab " * 40)]
    got = line_quality(documents(spark, rows)).collect()
    figures = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got)
    assert figures == sorted((-1 if i is None else i, *brute_quality(t)) for i, t in rows)
    assert not any(r.kept for r in got if r.base_failed)
    assert line_quality(documents(spark, [])).collect() == []


def test_line_rules():
    assert failing_rule("Home | About | Contact | Login") == "symbols" or failing_rule("Home | About | Contact | Login") == "navigation"
    assert failing_rule("aaaa### bbbb$$$ cccc%%%") == "symbols"
    assert failing_rule("Please accept cookies to go on.") == "boilerplate"
    assert failing_rule("THIS IS SHOUTED!! AT EVERYONE!!") == "capitals"
    assert failing_rule("A heading without a mark") == "punctuation"
    assert failing_rule("A plain sentence, with a comma.") is None
    assert failing_rule("word " * 30) is None  # long prose that was cut off
    assert split_lines("One sentence.\n\nmenu\nOne sentence.") == (["One sentence.", "", "One sentence."], 1, 4, 1)


def test_rejected_documents_go_and_clean_ones_stay(spark):
    clean = "\n".join(" ".join(prose(k, 12)) + "." for k in range(8))
    rows = [(1, clean), (2, clean + "\nhome menu"), (3, "\n".join(["a b c d e"] * 3 + [" ".join(prose(9, 25)) + "."])), (4, None), (None, clean)]
    docs = documents(spark, rows)
    kept = keep_clean(docs)
    assert kept.schema == docs.schema
    assert sorted((r.doc_id or 0, r.text, r.n_chars) for r in kept.collect()) == [(0, clean, len(clean)), (1, clean, len(clean)), (2, clean, len(clean))]


def test_repeated_words_of_overlapping_windows():
    words = [str(k) for k in range(20)] + ["z"] * 10 + [str(k) for k in range(5, 15)]
    assert repeated_words(word_hashes([w.encode() for w in words])) == brute_quality(" ".join(words))[4]


# -- substring dedup -----------------------------------------------------------


def key_of(text):
    """Spark's hash of a text: xxHash64 with seed 42, signed."""
    return int(np.uint64(xxhash.xxh64_intdigest(text.encode(), 42)).view(np.int64))


def brute_repeats(rows, min_words=8, unit_words=3):
    seen, marked = {}, {}
    docs = sorted({(i, key_of(t), t) for i, t in rows if i is not None and t})
    for i, key, t in docs:
        for number, (a, b, unit) in enumerate(units(t)):
            words = unit.lower().split()
            if len(words) >= unit_words:
                first = seen.setdefault(" ".join(words), (i, key, a))
                if first != (i, key, a):
                    marked.setdefault((i, key), []).append((number, a, b, len(words)))
    out = set()
    for (i, key), found in marked.items():
        run = []
        for k, item in enumerate(found):
            run.append(item)
            if k + 1 == len(found) or found[k + 1][0] > item[0] + 1:
                if sum(x[3] for x in run) >= min_words:
                    out |= {(i, key, a, b) for _, a, b, _ in run}
                run = []
    return out


def sentences(seed, n):
    return [" ".join(prose(seed * 50 + k, random.Random(seed + k).randint(1, 14))).capitalize() + "." for k in range(n)]


def test_repeats_equal_brute_force(spark):
    rnd = random.Random(4)
    passages = [sentences(900 + k, 5) for k in range(4)]
    rows = []
    for i in range(30):
        text = sentences(i % 25, 6)
        if rnd.random() < 0.5:
            at = rnd.randrange(6)
            text[at:at] = rnd.choice(passages)
        rows.append((i, rnd.choice([" ", "\n"]).join(text)))
    rows += [(40, "Short one. " * 5), (41, "Short one."), (900, None), (901, ""), (None, rows[0][1]), rows[3]]
    rows += [(7, " ".join(passages[0] + sentences(333, 3))), (7, " ".join(sentences(334, 2) + passages[0])), (7, rows[7][1])]
    got = repeated_spans(documents(spark, rows).repartition(4)).collect()
    assert {(r.doc_id, r.text_key, r.start, r.end) for r in got} == brute_repeats(rows)
    assert len(got) == len(brute_repeats(rows))
    assert all(r.kept_doc_id <= r.doc_id for r in got)
    assert repeated_spans(documents(spark, [])).collect() == []


def test_spans_are_cut_and_all_columns_stay(spark):
    passage = " ".join(sentences(77, 8))
    rows = [(1, "Own words open this one. " + passage), (2, "Another text opens here now. " + passage + " And ends."), (3, "Untouched  text."), (None, passage), (4, None)]
    docs = documents(spark, rows)
    out = {r.doc_id: r for r in without_repeats(docs).collect()}
    assert out[1].text == rows[0][1] and out[3].text == "Untouched  text." and out[4].text is None
    assert out[2].text == "Another text opens here now. And ends." and out[2].n_chars == len(out[2].text)
    assert out[None].text == passage
    assert without("abc def ghi", [(4, 7)]) == "abc ghi"


def test_rows_that_share_an_id_lose_their_own_repeats_only(spark):
    passage = " ".join(sentences(78, 6))
    other = "A wholly different text that happens to share the id and must not be cut at all here."
    rows = [(0, passage), (1, "Opening words stand here. " + passage), (1, other), (1, passage + " And more."), (1, None), (None, passage)]
    got = sorted(str((r.doc_id, r.text)) for r in without_repeats(documents(spark, rows)).collect())
    assert got == sorted(map(str, [(0, passage), (1, "Opening words stand here. "), (1, other), (1, "And more."), (1, None), (None, passage)]))


# -- personal data -------------------------------------------------------------

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    out = []
    for rank, (kind, form) in enumerate(FORMS.items()):
        for m in re.finditer(form, text):
            digits = re.sub(r"[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                total = sum(sum(map(int, str(int(d) * (1 + k % 2)))) for k, d in enumerate(reversed(digits)))
                if not 14 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), rank, m.end(), kind))
    return [(k, a, b) for a, _, b, k in sorted(out)]


@pytest.mark.parametrize("alphabet", ["ab1.@-_ ", "0123. ", "0123456789 -", "+12 ().-3", "a@b.c1 +2-\n", "é@a.b "])
def test_forms_equal_the_patterns(alphabet):
    rnd = random.Random(alphabet)
    for _ in range(3000):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40)))
        assert base_spans(text) == brute_spans(text), text
    cards = "4111 1111 1111 1111 and 4111-1111-1111-1112, 378282246310005"
    assert [s[0] for s in base_spans(cards)] == [s[0] for s in brute_spans(cards)] == ["card", "card"]


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "a@" * 100_000, "1" * 300_000, "1." * 100_000, "+1" * 100_000, "1 " * 100_000):
        base_spans(text)


def test_report(spark):
    rows = [(1, "mail a.b@c.de or +1 (988) 555-2485, host 10.0.0.1"), (2, None), (3, "plain"), (None, "x@y.zz"), (1, "mail a.b@c.de or +1 (988) 555-2485, host 10.0.0.1")]
    out = span_report(personal_spans(documents(spark, rows))).collect()
    assert len(out) == 5
    one = [r for r in out if r.doc_id == 1][0]
    want = ",".join(f"{k}:{a}:{b}" for k, a, b in brute_spans(rows[0][1]))
    assert one.base_sha256 == hashlib.sha256(want.encode()).hexdigest() and one.spans == want
    assert (one.n_email, one.n_ip, one.n_card, one.n_phone) == (1, 1, 0, 1)
    empty = [r for r in out if r.doc_id == 2][0]
    assert empty.spans == "" and empty.base_sha256 == hashlib.sha256(b"").hexdigest()
    assert span_report(personal_spans(documents(spark, []))).collect() == []


def test_disclosing_terms(spark):
    # "falcon" stands beside one address and nowhere else; "the" is everywhere.
    rows = [(k, f"the note of falcon chief x@y.zz was read by the team {k}") for k in range(5)]
    rows += [(10 + k, f"the chief wrote to w{k}@y.zz about the note by the team") for k in range(6)]
    rows += [(100 + k, "the team of the " + " ".join(prose(k, 10))) for k in range(40)]
    spans = {r.doc_id: r for r in personal_spans(documents(spark, rows)).collect()}
    text = dict(rows)
    masked = {text[0][s.start : s.end] for s in spans[0].terms}
    assert "falcon" in masked and "the" not in masked and "chief" not in masked
    assert not spans[10].terms and not spans[100].terms
    clean = {r.doc_id: r.text for r in sanitise(documents(spark, rows)).collect()}
    assert "falcon" not in clean[0] and "[EMAIL]" in clean[0] and clean[100] == text[100]
    assert sanitised("abcdef", [(1, 3, "X"), (2, 4, "Y")]) == "aXef"


def test_terms_disclose_from_anywhere_in_the_document(spark):
    between = " ".join(prose(3, 30))
    rows = [(k, f"Notes on Falcon\n\n{between} n{k}\nx@y.zz\n{between}\nsigned, falcon {k}") for k in range(4)]
    # The term tells the entity here too; it stays in a document without the entity.
    rows += [(10, f"falcon {between} {between}\n+1 (988) 555-2485 x@y.zz éx@y.zz falconry"), (11, f"a falcon of another text {between}")]
    rows += [(100 + k, f"{between} {between} " + " ".join(prose(50 + k, 10))) for k in range(40)]
    text = dict(rows)
    spans = {r.doc_id: r.terms for r in personal_spans(documents(spark, rows)).collect()}
    places = lambda k: [m.span() for m in re.finditer(r"(?i)\bfalcon\b", text[k])]
    for k in (0, 1, 2, 3, 10):
        assert set(places(k)) <= {(s.start, s.end) for s in spans[k]}
    assert not spans[11] and not spans[100]
    clean = {r.doc_id: r.text for r in sanitise(documents(spark, rows)).collect()}
    assert all("falcon" not in clean[k].lower().split() for k in (0, 1, 2, 3, 10)) and clean[11] == text[11]


def test_rows_without_a_doc_id_are_cleaned(spark):
    rows = [(None, "write to a.b@c.de now"), (None, "call +1 (988) 555-2485"), (None, None), (None, "plain"), (3, "write to a.b@c.de now"), (3, "host 10.0.0.1")]
    got = sanitise(documents(spark, rows)).collect()
    want = [(None, "write to [EMAIL] now"), (None, "call [PHONE]"), (None, None), (None, "plain"), (3, "write to [EMAIL] now"), (3, "host [IP]")]
    assert sorted(map(repr, ((r.doc_id, r.text) for r in got))) == sorted(map(repr, want))
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got)


def test_names_beside_a_unique_address(spark):
    """A name that a mail address holds goes where it stands; common words and other documents keep theirs."""
    rows = [(k, "the report of " + " ".join(prose(k, 12))) for k in range(60)]
    rows += [(100, "Anna Schmidt\nwrites: the report is at anna.schmidt@x.com, said SCHMIDT. Annabel too."), (101, "the schmidt report"), (102, "the report from the.report9@x.com")]
    text = dict(rows)
    terms = {r.doc_id: {text[r.doc_id][t.start : t.end] for t in r.terms} for r in personal_spans(documents(spark, rows)).collect()}
    assert terms[100] == {"Anna", "Schmidt", "SCHMIDT"}
    assert not terms[101] and not terms[102] and not terms[0]
    clean = {r.doc_id: r.text for r in sanitise(documents(spark, rows)).collect()}
    assert "chmidt" not in clean[100].lower() and "[EMAIL]" in clean[100] and "Annabel" in clean[100] and clean[101] == text[101]


def test_entities_of_two_documents_and_exact_keys(spark):
    rows = [(k, "the report of " + " ".join(prose(k, 12))) for k in range(60)]
    rows += [(100, "operation kestrel host 1.23.4.5 the report"), (101, "again kestrel via 1.23.4.5 now"), (102, "other host 12.3.4.5 osprey"), (103, "ab@x.com and osprey"), (104, "a.b@x.com or heron")]
    text = dict(rows)
    terms = {r.doc_id: {text[r.doc_id][t.start : t.end] for t in r.terms} for r in personal_spans(documents(spark, rows)).collect()}
    assert terms[100] == terms[101] == {"kestrel"}
    # 1.23.4.5 and 12.3.4.5, ab@x.com and a.b@x.com are different; each stands in one document only.
    assert not terms[102] and not terms[103] and not terms[104]
    assert len({entity_of(t, k, 0, len(t)) for k, t in (("ip", "1.23.4.5"), ("ip", "12.3.4.5"), ("email", "a.b@x.com"), ("email", "ab@x.com"), ("email", "AB@x.com"))}) == 4
    assert entity_of("+1 (98) 85-5", "phone", 0, 12) == entity_of("+1 98 855", "phone", 0, 9)


@pytest.mark.parametrize("seed", [1, 2])
def test_terms_without_broadcasts(spark, monkeypatch, seed):
    """Shuffled joins give what broadcasts give."""
    rows = [(k, " ".join(prose(seed * 99 + k % 9, 15)) + f" x{k % 7}.kite@y.zz" * (k % 3 == 0)) for k in range(50)]
    want = sorted(map(str, personal_spans(documents(spark, rows)).collect()))
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    assert sorted(map(str, personal_spans(documents(spark, rows)).collect())) == want


def test_pieces_outside_spans():
    rnd = random.Random(6)
    for _ in range(3000):
        text = "".join(rnd.choice("ab1.@-_ +2é\n") for _ in range(rnd.randint(0, 40)))
        spans = base_spans(text)
        words = [m.span() for m in re.finditer(r"[0-9A-Za-z\x80-\U0010FFFF]+", text)]
        want = [(a, b) for a, b in words if not any(x < b and a < y for _, x, y in spans)]
        pieces = list(outside(text, spans))
        assert [(a + m.start(), a + m.end()) for a, b in pieces for m in re.finditer(r"[0-9A-Za-z\x80-\U0010FFFF]+", text[a:b])] == want


def test_pmi_matches_brute_force(spark):
    rnd, rows = random.Random(8), []
    for k in range(60):
        words = [rnd.choice(["red", "blue", "green", "iron", "gold", "salt"]) for _ in range(6)]
        if rnd.random() < 0.6:
            words.insert(rnd.randrange(6), rnd.choice(["p@q.rs", "t@u.vw"]))
        rows.append((k, " ".join(words)))
    near, holds = {}, {}
    for k, text in rows:
        words = text.split()
        for w in set(words):
            holds.setdefault(w, set()).add(k)
        for e, t in {(e, t) for e, t in itertools.permutations(set(words), 2) if "@" in e and "@" not in t}:
            near.setdefault((e, t), set()).add(k)
    flagged = set()
    for (e, t), both in near.items():
        gain = np.log((len(both) - 0.5) * len(rows) / (len(holds[t]) * len(holds[e])))
        if len(both) >= 3 and gain >= 0.3 * np.log(len(rows) / len(holds[e])):
            flagged |= {(k, t) for k in both}
    got = personal_spans(documents(spark, rows), window=8, min_docs=3, generalise=0.3).collect()
    text = dict(rows)
    assert {(r.doc_id, text[r.doc_id][s.start : s.end]) for r in got for s in r.terms} == flagged
