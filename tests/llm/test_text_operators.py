"""BPE, licenses, PII and decontamination against brute force on small tables."""

import hashlib
import os
import random
import re
import sys

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from helpers import DOCS, odd_documents, odd_frame, shingle_counts, words  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from rankspan.llm import bpe, decontamination, gbt, licenses, pii  # noqa: E402
from rankspan.llm.queries import vocabulary_path  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary_path())
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def texts():
    return pq.read_table(f"{SF}/documents.parquet", columns=["text"]).column(0).to_pylist()


def test_bpe_equals_the_library(library, texts):
    codec = bpe.BpeCodec(open(vocabulary_path(), "rb").read())
    odd = ["", " ", "<|startoftext|>Hi<|endoftext|> there's I'll", "İstanbul ΣΑΣ é x\x1cy\x85z\x00q", "a" * 5000,
           "\U0001F600 ok ½ ² 12345 ١٢", "don't DON'T 'S", "<|endoftext|", "\0 <|endoftext|>"]
    everything = texts + odd
    for text, ids, ref in zip(everything, codec.encode(everything), library.encode_batch(everything, add_special_tokens=False)):
        assert ids.tolist() == ref.ids, text[:80]
        assert codec.decode(ids).decode() == library.decode(ref.ids, skip_special_tokens=False)


def test_bpe_query_rows(spark, library):
    got = sorted(tuple(r) for r in bpe.bpe_digests(odd_frame(spark), vocabulary_path()).collect() if r["doc_id"] is not None)
    want = []
    for i, text, *_ in odd_documents():
        if i is not None:
            ids = library.encode(text or "", add_special_tokens=False).ids
            raw = b"".join(x.to_bytes(4, "little") for x in ids)
            want.append((i, len(ids), hashlib.sha256(raw).hexdigest(),
                         hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want)
    docs = odd_frame(spark)
    both = bpe.decode_documents(bpe.encode_documents(docs, vocabulary_path()), vocabulary_path())
    assert both.count() == docs.count() and {"ids", "decoded", "score"} <= set(both.columns)
    assert bpe.bpe_digests(docs.limit(0), vocabulary_path()).count() == 0


def test_bpe_keeps_no_words_between_tasks(spark):
    """A worker outlives its task: the words learnt are not left to the next stage."""
    def kept(batches):
        from rankspan.llm import bpe as there
        for batch in batches:
            n = sum(len(c.known) + len(c.ids) for c in there._CODECS.values())
            yield pa.RecordBatch.from_arrays([pa.array([len(there._CODECS)]), pa.array([n])], names=["codecs", "n"])

    docs = spark.range(0, 64, 1, 8).selectExpr("id AS doc_id", "concat('some words and number ', id) AS text")
    assert bpe.bpe_digests(docs, vocabulary_path(), with_ids=True).where("n_tokens > 0 and size(ids) = n_tokens").count() == 64
    found = docs.select("doc_id").mapInArrow(kept, "codecs long, n long").collect()
    assert sum(r["codecs"] for r in found) > 0 and sum(r["n"] for r in found) == 0


def brute_spans(text):
    def luhn(s):
        total = 0
        for i, c in enumerate(reversed(s)):
            x = int(c) * (1 + i % 2)
            total += x - 9 if x > 9 else x
        return total % 10 == 0

    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for kind, pattern in kinds.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m.group().split("."))
                    or kind == "card" and 13 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 9 <= len(digits) <= 15):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_pii_base_spans(spark, texts):
    r = random.Random(5)
    pieces = ["a@b.c", "x.y+z@mail.example.com", "@", "a@b", "a@b.c_d@e.f", "1.2.3.4", "1.2.3.4.5.6.7.8", "999.1.1.1", "0001.2.3.4",
              "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 555-0100", "+1", "++12345678901", "漢字", "\U0001F600", "é", " ", "\n",
              "password=abcdef0123456789ab", "12", "-", "."]
    odd = ["".join(r.choice(pieces) + r.choice(["", " "]) for _ in range(r.randint(1, 14))) for _ in range(400)]
    rows = [(i, t, None, None, None) for i, t in enumerate(odd + texts + [None, "", "9" * 20_000, "a" * 20_000 + "@" + "b.c" * 3000])]
    docs = spark.createDataFrame(rows, DOCS)
    for row in pii.scan(docs).collect():
        want = brute_spans(rows[row["doc_id"]][1] or "")
        assert row["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), rows[row["doc_id"]][1]
        assert (row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]) == tuple(
            sum(s.startswith(k + ":") for s in want) for k in ("email", "ip", "card", "phone"))
        assert set(want) <= set(row["spans"].split(",") if row["spans"] else [])


def test_pii_odd_tables(spark):
    docs = odd_frame(spark)
    assert pii.scan(docs).count() == docs.count()
    assert pii.scan(docs.limit(0)).count() == 0
    some = spark.createDataFrame([(1, "mail a@b.c or 1.2.3.4.", "en", None, 22), (2, None, None, None, None)], DOCS)
    out = {r["doc_id"]: r for r in pii.redact(some).collect()}
    assert out[1]["text"] == "mail [EMAIL] or [IP]." and out[1]["n_chars"] == 21 and out[2]["text"] is None
    assert pii.redact(docs).columns == docs.columns
    plan = pii.scan(some)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_pii_candidates_of_any_length(spark):
    key = "k3" + "Ab" * 149
    texts = ["token=" + "x7-_" * 80, key, "u" * 90 + "@" + "h" * 300, "5" + " 55" * 40, "1" + " " * 100_000, "a1" * 50_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: {(c["kind"], c["s"], c["e"]) for c in r["_cand"]} for r in pii.candidates(pii.base_spans(docs)).collect()}
    for i, kind in ((0, "secret"), (1, "secret"), (2, "email"), (3, "phone"), (5, "secret")):
        assert (kind, 0, len(texts[i])) in found[i], i
    assert not found[4]


def test_pii_adds_spans_that_base_patterns_miss(spark):
    r = random.Random(9)
    rows = []
    for i in range(600):
        number = f"({r.randint(200, 999)}) {r.randint(200, 999)}-{r.randint(1000, 9999)}"
        rows.append((i, f"{words(8, i)} call +1 {number} {words(4, i + 1)} or mail w{i}.x@host{i % 7}.example.com {words(4, i)} of "
                        f"{r.randint(1990, 2030)} {words(2, i)} pwd: {words(1, i)}Zq{r.randint(100, 999)}xyz {words(3, i + 2)} "
                        f"{r.randint(10**7, 10**8 - 1)} {words(2, i)}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model, least = pii.train(docs)
    assert not np.isinf(least[0]) and not np.isinf(least[2])
    text = "Phone 1 (412) 583-9607 today, api_key=Zebra-unhexed-7 and 12345678 things"
    other = spark.createDataFrame([(1, text)], "doc_id long, text string")
    added = {(x["kind"], text[x["s"]:x["e"]]) for x in pii.find(other, model, least).first()["_spans"]}
    assert added == {("phone", "1 (412) 583-9607"), ("secret", "api_key=Zebra-unhexed-7")}
    one = docs.where("doc_id = 0").select(pii.masked(F.col("text")).alias("m"), "text").first()
    assert len(one["m"]) == len(one["text"]) and "host0-example-com" in one["m"] and "+" not in one["m"]


def test_pii_adds_where_all_examples_are_positive(spark):
    rows = [(i, f"{words(5, i)} pwd: Zq{i}xyzw {words(3, i)}") for i in range(40)]
    model, least = pii.train(spark.createDataFrame(rows, "doc_id long, text string"), decoys=0)
    assert not len(model.value) and np.isfinite(least[0]) and np.isinf(least[1:]).all()


def test_pii_learns_from_written_negatives(spark):
    """Documents whose candidates are all positive: the decoys teach the rest."""
    r = random.Random(4)
    rows = [(i, f"{words(5, i)} pwd: Zq{i}xy{r.randint(10, 99)}w {words(3, i)} call +1 ({r.randint(200, 999)}) {r.randint(200, 999)}-"
                f"{r.randint(1000, 9999)} {words(3, i)} mail w{i}.x@host{i % 7}.example.com {words(2, i)} "
                f"AKIA{''.join(r.choice('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') for _ in range(15))}7") for i in range(120)]
    model, least = pii.train(spark.createDataFrame(rows, "doc_id long, text string"))
    assert len(model.value) and np.isfinite(least).all()
    decoys = pii.decoy_texts(spark, 900).where("doc_id >= 500")
    wrong = pii.find(decoys, model, least).select(F.explode(F.filter("_spans", lambda s: ~F.array_contains(
        F.transform("_base", lambda b: b["s"]), s["s"])))).count()
    assert wrong <= 0.01 * 400 * 15


def test_pii_many_matches_in_one_text(spark):
    """Blocks of matches: positions, context and redaction against plain Python."""
    r = random.Random(6)
    pieces = [f"w{i}@ex.com" if i % 3 else f"+1 555 {r.randint(1000000, 9999999)};" for i in range(3 * pii.BLOCK + 5)]
    gaps = [r.choice([" ", " é漢 ", " plain words here and more of them "]) for _ in pieces]
    text = "".join(g + p for g, p in zip(gaps, pieces)) + " \U0001F600 end"
    docs = spark.createDataFrame([(1, text), (2, text[:40])], "doc_id long, text string")
    got = {x["doc_id"]: x for x in pii.scan(docs).collect()}
    for i, t in ((1, text), (2, text[:40])):
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(brute_spans(t)).encode()).hexdigest()
    found = docs.select(pii._matches(F.col("text"), pii.PATTERNS["email"], pii.GATES["email"]).alias("m")).first()["m"]
    assert len(found) == sum(i % 3 > 0 for i in range(len(pieces)))
    assert all(text[m["s"]:m["e"]] == m["v"] and text[max(0, m["s"] - pii.CONTEXT):m["s"]] == m["b"] for m in found)
    spans = [x.split(":") for x in got[1]["spans"].split(",")]
    want, at = "", 0
    for kind, s, e in sorted(spans, key=lambda x: (int(x[1]), int(x[2]), x[0])):
        if int(s) >= at:
            want += text[at:int(s)] + f"[{kind.upper()}]"
        at = max(at, int(e))
    assert pii.redact(docs).where("doc_id = 1").first()["text"] == want + text[at:]


def test_pii_threshold_of_each_generator():
    score, truth = np.array([3.0, 2, 1, 3, 2, 2]), np.array([1.0, 1, 0, 1, 1, 0])
    assert pii.thresholds(score, truth, np.array([0, 0, 0, 2, 2, 2])) == [2.0, float("inf"), 3.0, float("inf")]


def test_license_places_and_templates(spark):
    mit = licenses.TEMPLATES[0][1].replace("[[", "").replace("]]", "")
    rows = [(1, "x under the MIT License, under the mit-license."), (2, "Apache License, Version 2.0; CC BY-NC 4.0"), (3, None), (4, ""),
            (5, "(C) 2020\n" + mit.upper()), (6, mit.replace("publish", "print")),
            (7, "GNU General Public License, version 3."), (8, "ünder the mit license"), (9, "under themit license")]
    got = {r["doc_id"]: r for r in licenses.scan_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1]["n_words"], got[1]["n_base"], got[1]["first_word"], got[1]["last_word"], got[1]["base_labels"]) == (9, 2, 1, 5, "mit")
    assert got[2]["base_labels"] == "apache-2,cc-by-nc" and got[2]["score"] == 1.0
    assert (got[3]["n_words"], got[3]["first_word"], got[3]["labels"], got[3]["score"]) == (0, None, "", 0.0) and got[4]["n_words"] == 0
    assert got[5]["labels"] == "mit" and got[5]["base_labels"] == ""
    assert got[6]["labels"] == "" and 0 < got[6]["score"] < 1
    assert got[7]["labels"] == "gpl-3" and got[8]["labels"] == "" and got[9]["n_base"] == 0
    docs = odd_frame(spark)
    assert licenses.scan_documents(docs).count() == docs.count() and licenses.scan_documents(docs.limit(0)).count() == 0


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in
the documentation and/or other materials provided with the distribution.
%sTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT
NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
NAMES = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
         "derived from this software without specific prior written permission.\n")
ADVERTISING = ("3. All advertising materials mentioning features or use of this software must display the following acknowledgement: "
               "This product includes software developed by the organization.\n")
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR
ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for
any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this
software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""


def test_licenses_to_the_end_of_their_wording():
    scan = licenses.LicenseScanner().scan
    for label, text, late in (("mit", MIT, "DEALINGS"), ("bsd-2", BSD % "", "ADVISED"), ("bsd-3", BSD % NAMES, "ADVISED"),
                              ("isc", ISC, "PERFORMANCE"), ("zlib", ZLIB, "removed")):
        assert scan("Copyright x\n" + text + "\nmore")[5:] == (label, 1.0), label
        labels, score = scan(text.replace(late, "altered"))[5:]
        assert labels == "" and 0.5 < score < 1, label
    assert scan(BSD % (ADVERTISING + NAMES.replace("3.", "4.")))[5] == ""
    assert scan(MIT.replace("THE SOFTWARE IS PROVIDED", "The Software shall be used for Good, not Evil. THE SOFTWARE IS PROVIDED"))[5] == ""
    for label, name in (("cc-by-sa", "Attribution-ShareAlike"), ("cc-by-nc", "Attribution-NonCommercial"), ("cc-by", "Attribution")):
        assert scan(f"under a Creative Commons {name} 4.0 International License.")[5:] == (label, 1.0)
    assert scan("Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License")[5] == ""


def test_template_markup():
    automaton = licenses.TokenAutomaton("x", "one two [[maybe so]] three {{2}} end")
    for text, ok in (("one two three end", 1), ("one two maybe so three end", 1), ("one two three a b end", 1),
                     ("one two three a b c end", 0), ("one two maybe three end", 0), ("one two three", 0)):
        assert (automaton.match([w.encode() for w in text.split()], 0) == 1.0) == bool(ok), text
    with pytest.raises(ValueError):
        licenses.parse("a [[ b")


def test_decontamination_equals_brute_force(spark):
    r = random.Random(2)
    items = [(i, words(r.randint(5, 60), 100 + i)) for i in range(25)] + [(90, "too short"), (91, None), (92, "")]
    docs = []
    for d in range(60):
        text = words(r.choice([20, 400, 3000]), 1000 + d).split()
        if d % 3 == 0:
            piece = items[d % 25][1].split()
            if d % 2:
                piece[len(piece) // 2] = "other"
            at = r.randrange(len(text))
            text[at:at] = piece
        docs.append((d, " ".join(text)))
    docs += [(70, None), (71, ""), (72, items[3][1]), (72, items[3][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = []
    for d, t in docs:
        own = set(shingle_counts(t)) if t and len(t.split()) >= 5 else set()
        for i, q in items:
            s = set(shingle_counts(q)) if q and len(q.split()) >= 5 else set()
            if s and len(s & own) >= 0.8 * len(s):
                want.append((d, i, round(len(s & own) / len(s), 9)))
    for block in (decontamination.BLOCK_BYTES, 1500):        # also with several blocks of items
        got = decontamination.find(frame, bench, block_bytes=block).collect()
        assert sorted((r_["doc_id"], r_["item_id"], round(r_["containment"], 9)) for r_ in got) == sorted(want)
    kept = decontamination.drop_contaminated(frame, bench)
    assert sorted(x["doc_id"] for x in kept.collect()) == sorted(d for d, _ in docs if d not in {w[0] for w in want})
    assert decontamination.find(frame.limit(0), bench).count() == 0 and decontamination.find(frame, bench.limit(0)).count() == 0
    odd = odd_frame(spark)
    assert decontamination.drop_contaminated(odd, bench).columns == odd.columns


def test_short_benchmark_items_are_found(spark):
    items = [(1, "Forty two"), (2, "one"), (3, "four words in all"), (4, " "), (5, "forty  TWO"), (6, words(20, 3))]
    docs = [(1, "forty two"), (2, "it is forty two now"), (3, "forty and two"), (4, "none"), (5, "xx four words in all " + words(20, 3)),
            (6, "four words in"), (7, "one one"), (8, "ends with forty"), (9, "two begins"), (10, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = [(1, 1), (1, 5), (2, 1), (2, 5), (5, 3), (5, 6), (7, 2)]
    got = decontamination.find(frame, bench).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == want and all(r["containment"] == 1.0 for r in got)
    few = decontamination.find(frame, bench.where("item_id < 4")).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in few) == [w for w in want if w[1] < 4]
    assert sorted(r["doc_id"] for r in decontamination.drop_contaminated(frame, bench).collect()) == [3, 4, 6, 8, 9, 10]


def test_pii_learns_from_all_candidates(spark, monkeypatch):
    """No candidate is left out, however many there are; equal ones are counted."""
    docs = spark.range(9000).select(F.col("id").alias("doc_id"), F.concat(
        F.lit("call +49 170 "), F.lpad(F.col("id").cast("string"), 7, "1"), F.lit(" now")).alias("text"))
    seen, grow, cut = [], pii.fit, pii.thresholds
    monkeypatch.setattr(pii, "fit", lambda x, y, **kw: seen.append(kw["times"].sum() if "times" in kw else len(x)) or grow(x, y, **kw))
    monkeypatch.setattr(pii, "thresholds", lambda s, y, g, *times: seen.append(times[0].sum() if times else len(s)) or cut(s, y, g, *times))
    pii.train(docs, decoys=0)
    assert sum(seen) == 9000


def test_counted_rows_give_the_trees_of_all_rows():
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(300, 4)), 1)
    y = (x[:, 0] + x[:, 1] * rng.normal(size=300) > 0).astype(float)
    times = rng.integers(1, 9, 300)
    a = gbt.fit(x, y, trees=6, depth=3, bins=12, times=times.astype(float))
    b = gbt.fit(np.repeat(x, times, axis=0), np.repeat(y, times), trees=6, depth=3, bins=12)
    assert (a.feature == b.feature).all() and (a.threshold == b.threshold).all() and np.abs(a.value - b.value).max() < 1e-9
    margin, g = a.margin(x), np.zeros(300)
    assert pii.thresholds(margin, y, g, times) == pii.thresholds(np.repeat(margin, times), np.repeat(y, times), np.repeat(g, times))
