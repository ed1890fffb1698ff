"""Fill-in-middle against a listing of the units, and the rank and select
arithmetic against plain scans."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from spindle.llm import fim

TEXTS = [None, "", "a", " ", "ab cd", "é", "漢字 mixed ß letters", "x" * 100_000, "😀" * 3000 + "end", "has <P> inside", "has <S>",
         "<M>", "<", "P>", "almost <P >", "tab\tnew\nline\r\n", "nul\0byte", "ASCII[\\]^_`{|}~@az AZ", "<S<S <P<M", "́combining",
         "mañana " * 5000]


def units(text):
    return re.findall("[A-Za-z]+|[^A-Za-z]", text or "")


def brute(doc_id, text, rate=90, spm=20):
    text = text or ""
    u, digest = units(text), hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    pre, mid, suf = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(u), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(u), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(u), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize("rate,spm", [(90, 20), (100, 50)])
def test_outputs_and_round_trip(spark, rate, spm):
    ids = [None, *range(1, 12)]
    rows = [(i, t, "mine", 5, "kept") for t in TEXTS for i in ids] + [(3, "ab cd", "mine", 5, "kept")] * 3
    table = spark.createDataFrame(rows, "doc_id long, text string, output string, n int, lang string")
    made = fim.fill_in_middle(table, rate=rate, spm_rate=spm)
    assert made.columns == ["doc_id", "text", "lang", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = made.withColumn("back", fim.restored(made.output, made.form)).collect()
    assert len(got) == len(rows) and {"plain", "psm", "spm"} == {r.form for r in got}
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute(r.doc_id, r.text, rate, spm)
        assert r.back == (r.text or "") and r.lang == "kept"
    assert fim.digest(fim.fill_in_middle(table.filter("false"))).count() == 0


def test_rank_and_select():
    draw = random.Random(7)
    for _ in range(60):
        texts = ["".join(draw.choice("aZ[z{@` é漢😀\n") for _ in range(draw.randrange(40))) for _ in range(draw.randrange(1, 9))]
        data = "".join(texts).encode()
        ends = np.cumsum([len(t.encode()) for t in texts])
        starts = np.concatenate([[0], ends[:-1]])
        last, first = fim.unit_marks(np.frombuffer(data, np.uint8), ends[ends > starts])
        want = np.cumsum([len(u.encode()) for t in texts for u in units(t)]) - 1
        assert last.select(np.arange(1, len(want) + 1)).tolist() == want.tolist()
        at = np.arange(len(data) + 1)
        assert last.rank(at).tolist() == [int((want < p).sum()) for p in at]
        assert first.rank(at).tolist() == [sum((b & 0xC0) != 0x80 for b in data[:p]) for p in at]


def test_every_cut():
    text = "Zo[é] 漢x😀 end"
    u = units(text)
    draws = np.array([(a, b) for a in range(len(u) + 1) for b in range(len(u) + 1)])
    n, at, chars = fim.cuts(pa.array([text] * len(draws)), draws)
    for (a, b), m, cut, c in zip(draws.tolist(), n.tolist(), at.tolist(), chars.tolist()):
        a, b = sorted((a, b))
        assert m == len(u) and cut == [len("".join(u[:a]).encode()), len("".join(u[:b]).encode())]
        assert c == [len("".join(u[:a])), len("".join(u[a:b]))]
