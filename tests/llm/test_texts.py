"""Operators on single texts against plain versions, and on awkward rows."""

import base64
import gzip
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.llm import bpe, langid, license_scan, packing, pii, secret_scan, toxicity

P = pytest.importorskip("public_tokenizers")


def same_ids(df, odd_rows):
    assert sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=str) == sorted((i for i, _ in odd_rows), key=str)


# --- byte-level BPE -------------------------------------------------------------


def test_bpe_equals_the_library(spark, odd, odd_rows, none):
    import tiktoken

    path = P.path("byte_bpe_50k.tiktoken")
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    got = bpe.round_trip(odd, path, P.PATTERN, keep=["doc_id", "text"])
    same_ids(got, odd_rows)
    for r in got.collect():
        text = r["text"] or ""
        want = own.encode_ordinary(text)
        assert np.frombuffer(r["ids"], dtype="<u4").tolist() == want
        assert r["n_tokens"] == len(want) and bytes(r["decoded"]) == text.encode()
    assert bpe.round_trip(none, path, P.PATTERN).count() == 0


def test_merges_where_a_later_rank_comes_up_earlier():
    ranks = {bytes([b]): 1000 + b for b in range(256)} | {b"ab": 5, b"abc": 2, b"bc": 7, b"aa": 3, b"aaa": 9}

    def plain(word):
        if word in ranks:
            return [ranks[word]]
        parts = [word[i : i + 1] for i in range(len(word))]
        while True:
            best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
            if best is None:
                return [ranks[p] for p in parts]
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    pick = random.Random(3)
    words = [bytes(pick.choice(b"abc") for _ in range(pick.randint(0, 14))) for _ in range(400)]
    assert bpe.replay_merges(words, ranks) == [plain(w) if w else [] for w in words]


# --- packing --------------------------------------------------------------------


def test_packing(odd, odd_rows, none):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    own = Tokenizer.from_file(path)
    rows = packing.pack_documents(odd, path, size=64, open_windows=3).collect()
    by_sequence, by_doc = {}, {}
    for r in rows:
        assert r["length"] == len(r["ids"]) // 4 and r["ids_crc32"] == zlib.crc32(r["ids"])
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append((r["start"], bytes(r["ids"]), r["doc_tokens"]))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    assert sum(sum(n for _, n in p) for p in by_sequence.values()) > 0.9 * 64 * len(by_sequence)
    for i, text in odd_rows:
        if i is None or i == 9:
            continue  # several rows of one id
        want = own.encode(text or "", add_special_tokens=False).ids + [1]
        ids = b"".join(p for _, p, _ in sorted(by_doc[i]))
        assert np.frombuffer(ids, dtype="<u4").tolist() == want and {t for _, _, t in by_doc[i]} == {len(want)}
    assert len(by_doc[9]) >= 2 and len(by_doc[None]) >= 2
    assert packing.pack_documents(none, path).count() == 0


@pytest.mark.parametrize("text", ["A. B, C.\n", "a!!. b", "‘x’. y", "<|endoftext|> A.", "é. É, ß.\n", "1. 2, 3", "_. a", "x.\ty"])
def test_chunks_tokenize_like_the_text(text):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.tokenizer(path)(text), dtype="<u4").tolist() == want


def test_texts_of_any_code_points_tokenize_alike():
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    own, pick = Tokenizer.from_file(path), random.Random(21)
    parts = "İ I\u0307 \u0307 \x1c \x1d \x85 \xa0 \u3000 . , K ß ﬁ Σ ς é \u200d 你 😀 <| |> 's ' 5".split(" ") + [" ", "\n", ". ", ", ", ".\n", "<|endoftext|>"]
    char = lambda: chr(pick.choice([pick.randrange(32, 127), pick.randrange(0, 0x250), pick.randrange(0, 0x3000), pick.randrange(0xA000, 0xD7FF)]))
    texts = ["".join(pick.choice(parts) if pick.random() < 0.5 else char() for _ in range(pick.randint(0, 25))) for _ in range(6_000)]
    texts += ["Dr. İ. Kaya", "AKDENİ, x", "a\x1c. b", "x" * 200 + ". " + "y" * 300 + ",", None, ""]
    coder = packing.Encoder(path)
    for at in range(0, len(texts), 50):
        for text, ids in zip(texts[at : at + 50], coder.encode(texts[at : at + 50])):
            assert np.frombuffer(ids, dtype="<u4").tolist() == own.encode(text or "", add_special_tokens=False).ids, text


def test_encoder_that_forgets(monkeypatch):
    """A full memory is dropped between two calls, never within one."""
    monkeypatch.setattr(packing, "MEMO_CHUNKS", 3)
    path = P.path("word_bpe_49k.json")
    coder, whole = packing.Encoder(path), packing.Encoder(path)
    texts = [f"one two, three{i}. {'long' * 30}{i}. " for i in range(40)]
    assert [coder.encode([t])[0] for t in texts] == whole.encode(texts)


def test_signs_behind_words_tokenize_alike():
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    own, pick = Tokenizer.from_file(path), random.Random(22)
    parts = [*map(chr, range(33, 127)), *"éÉßİŉſſ×÷\u0301\u0338\u3099\xa0 \n\t", "'s", "'re", "<|endoftext|>", "mail", "Ünô", "42", ".***", "\r\n"]
    texts = ["".join(pick.choice(parts) for _ in range(pick.randint(0, 18))) for _ in range(6_000)]
    coder = packing.Encoder(path)
    for at in range(0, len(texts), 500):
        for text, ids in zip(texts[at : at + 500], coder.encode(texts[at : at + 500])):
            assert np.frombuffer(ids, dtype="<u4").tolist() == own.encode(text, add_special_tokens=False).ids, text


def test_known_words_are_not_tokenized_again_for_their_signs(monkeypatch):
    coder, sent = packing.Encoder(P.path("word_bpe_49k.json")), []
    coder.encode(["alpha béta gamma"])
    tokenize = coder._tokenize
    monkeypatch.setattr(coder, "_tokenize", lambda chunks: tokenize([sent.append(c) or c for c in chunks]))
    coder.encode(["Alpha!! béta,%%% gamma. alpha.***"])
    assert sent and not any(c.decode()[0].isalpha() for c in sent), sent


# --- personal data ---------------------------------------------------------------


def plain_pii(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m.group())
        if 12 <= len(digits) <= 19 and pii.luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def test_base_pii_equals_the_patterns():
    pick = random.Random(5)
    for _ in range(4000):
        text = "".join(pick.choice("ab1290@@..-+ ()_%é") for _ in range(pick.randint(0, 60)))
        assert pii.base_spans(text) == plain_pii(text), text
    assert pii.base_spans("a" * 200_000 + "@") == []  # linear, whatever the words' length
    assert pii.luhn("4242424242424242") and not pii.luhn("4242424242424241")


def test_network_learns_and_base_spans_stay(spark, odd, odd_rows, none):
    pick = random.Random(8)
    card = lambda: next(c for c in iter(lambda: "".join(pick.choice("0123456789") for _ in range(16)), "") if pii.luhn(c))
    made = []
    for i in range(160):
        words = [pick.choice(["alpha", "beta", "gamma 7", "delta", "version 4.0"]) for _ in range(12)]
        kind = pick.choice([lambda: f"u{i}@mail{i % 7}.example.com", lambda: f"10.{i}.3.{i % 250}", card, lambda: f"+1 ({100 + i}) 555-{1000 + i}"])
        words.insert(pick.randint(0, 12), kind())
        made.append((i, " ".join(words)))
    docs = spark.createDataFrame(made, "doc_id long, text string")
    tagger = pii.train_tagger(docs)
    right = wrong = 0
    for _, text in made[:80]:
        want = {s for s in pii.base_spans(text)}
        got = set(pii.network_spans([text], tagger)[0])
        right += len(want & got)
        wrong += len(got - want)
    assert right >= 60 and wrong <= 20
    found = pii.find_pii(odd, tagger).collect()
    assert len(found) == len(odd_rows)
    for r in found:
        assert set(map(tuple, r["base"])) <= set(map(tuple, r["spans"]))
    seven = next(r for r in found if r["doc_id"] == 7)
    assert [s["kind"] for s in seven["base"]] == ["card", "email", "ip", "phone"]
    masked = {r["doc_id"]: r["text"] for r in pii.mask_pii(odd.where("doc_id in (1, 7)"), None).collect()}
    assert masked == {1: None, 7: "[CARD] [EMAIL] [IP] [PHONE]"}
    assert pii.mask_pii(odd, tagger).columns == odd.columns
    assert pii.train_tagger(none) is None and pii.find_pii(none, None).count() == 0


def test_gradients():
    rng = np.random.default_rng(0)
    codes, tags = rng.integers(0, 17, (3, 7)), rng.integers(0, 9, (3, 7))
    net = pii.Tagger(hidden=4)

    def loss():
        emit, _ = net.scores(codes)
        alpha, path = emit[:, 0], emit[np.arange(3), 0, tags[:, 0]].copy()
        for t in range(1, 7):
            alpha = pii._logsumexp(alpha[:, :, None] + net.p["t"], 1) + emit[:, t]
            path += net.p["t"][tags[:, t - 1], tags[:, t]] + emit[np.arange(3), t, tags[:, t]]
        return (pii._logsumexp(alpha, 1) - path).mean()

    grads = net.gradients(codes, tags)
    for name in net.p:
        flat = net.p[name].reshape(-1)
        for at in rng.integers(0, flat.size, 4):
            flat[at] += 1e-5
            up = loss()
            flat[at] -= 2e-5
            down = loss()
            flat[at] += 1e-5
            assert grads[name].reshape(-1)[at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


# --- secrets ---------------------------------------------------------------------

_PLAIN_ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A
)


def plain_secrets(text):
    found = [(m.start(), 0, m.end()) for m in _PLAIN_ASSIGN.finditer(text) if len(m.group(1)) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 16]
    return sorted(found)


def test_base_secrets_equal_the_patterns():
    pick = random.Random(4)
    parts = ["token", "TOKEN", "ſecret", "secret", "apikey", "api_key", "=", ": ", '"', "abcdef0123456789", "AKIA", "AKIAABCDEFGHIJKLMN", " ", "Zz9+/"]
    for _ in range(3000):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(0, 12)))
        assert secret_scan.base_spans(text) == plain_secrets(text), text


def test_nested_layers(odd, odd_rows, none):
    secret = "token=abcdefghijklmnop"
    b64 = lambda b: base64.b64encode(b).decode()
    inner = b64(secret.encode())
    blobs = {
        "base64": inner, "twice": b64(f"see {inner} here".encode()), "gzip": b64(gzip.compress(secret.encode())),
        "zlib in base64": b64(b64(zlib.compress(secret.encode())).encode()),
    }
    for name, blob in blobs.items():
        text = f"before {blob} after"
        (span,) = secret_scan.decoded_spans(text)
        assert text[span[0] : span[2]].rstrip("=") == blob.rstrip("="), name
    url = "go x?token%3Dabcdefghijkl%6Dnop end"
    assert [url[s:e] for s, _, e in secret_scan.decoded_spans(url)] == ["token%3Dabcdefghijkl%6Dnop"]
    code = "\\" + "u0074"  # an escaped t
    uni = f"k {code}oken=abcdefghijklmnop"
    assert [uni[s:e] for s, _, e in secret_scan.decoded_spans(uni)] == [f"{code}oken=abcdefghijklmnop"]
    double = "token%253Dabcdefghijklmnop"
    assert [double[s:e] for s, _, e in secret_scan.decoded_spans(double)] == [double]
    assert secret_scan.decoded_spans("plain %zz \\q " + "A" * 40) == []
    big = b64(gzip.compress(b"x " * 1_500_000 + secret.encode()))
    assert len(secret_scan.decoded_spans(f"a {big} b")) == 1  # scanned window by window
    found = secret_scan.find_secrets(odd)
    same_ids(found, odd_rows)
    assert secret_scan.find_secrets(none).count() == 0


def test_wrapped_and_shifted_blobs():
    secret = "token=abcdefghijklmnop"
    noise = "".join(random.Random(5).choice("ghjkmpqrvwxyz ,") for _ in range(700))
    plain, packed = f"{noise[:47]}{secret}{noise}".encode(), gzip.compress(f"{noise}{secret}{noise[:99]}".encode())
    found = lambda t: {t[s:e] for s, _, e in secret_scan.decoded_spans(t)}
    for width in (64, 76):
        for raw in (plain, packed, zlib.compress(plain)):
            blob = base64.b64encode(raw).decode()
            for end in ("\n", "\r\n", "\n  "):
                wrapped = end.join(blob[i : i + width] for i in range(0, len(blob), width))
                for before, after in (("", ""), ("-----BEGIN KEY-----\n", "\n-----END KEY-----\n"), ("data: ", "\nand more words")):
                    assert wrapped in found(before + wrapped + after), (width, end, before)
    for raw in (plain, packed, zlib.compress(plain)):
        blob = base64.urlsafe_b64encode(raw).decode().rstrip("=")
        for before in ("v1/", "files/v1-", "a/bb/", "download/x_"):
            assert blob in found(f"https://x.org/{before}{blob}?a"), before
    members = gzip.compress(b"first member") + gzip.compress(secret.encode())
    assert len(found(base64.b64encode(members).decode())) == 1
    assert secret_scan.decoded_spans("a-very-long-word-at-the-end\nand\nmore\n" * 3) == []


def test_escapes_around_blanks():
    found = lambda t: [t[s:e] for s, _, e in secret_scan.decoded_spans(t)]
    quote = "\\" + "u0022"
    for secret in (
        f"password{quote}: {quote}abcdefghijkl", "secret%3A abcdefghijklmnop", "token: %22abcdefghijklmnop", "api_key&#61; &#34;abcdefghijklmnop",
        "token%253A  %2522abcdefghijklmnop",
    ):
        assert found(f"a %41\n  say {secret} or {quote} é") == [secret]
    blob = base64.b64encode(b"see token=abcdefghijklmnop there").decode()
    coded = blob[:22] + "%0A" + blob[22:]
    assert found(f"%7B {coded} %7D") == [coded]


def test_layers_that_begin_unreadable_or_are_cut():
    b64 = lambda b: base64.b64encode(b).decode()
    secret = b"token=abcdefghijklmnop"
    for raw in (b"\0" * 512 + secret, secret + b"\xff", b"\x08\x96\x01\x12" * 9 + secret, b"\0\xfe" * 300 + b64(secret).encode()):
        assert len(secret_scan.decoded_spans(f"a {b64(raw)} b")) == 1
    pick = random.Random(8)
    noise = lambda n: bytes(pick.choice(b"ghjk(pqr") for _ in range(n))
    size = secret_scan.WINDOW_BYTES
    for nested in (noise(9000) + secret + noise(9000), gzip.compress(noise(30_000) + secret), b"%41" * 3000 + b"\n" + secret):
        for before in (size - 9000, size - 5000, size - 9):
            layer = b"(" * before + b" " + b64(nested).encode() + b" (" * 99
            assert len(secret_scan.decoded_spans(f"a {b64(gzip.compress(layer))} b")) == 1
    lone = b64(b"(" * 13_000_000 + secret + b"(" * 900)
    assert len(secret_scan.decoded_spans(f"a {b64(gzip.compress(lone.encode(), 1))} b")) == 1


# --- languages -------------------------------------------------------------------


def test_cross_parsing():
    made = langid.SuffixAutomaton("abcbc dab")
    text = "abcbc dab"

    def plain(word):
        n, i = 0, 0
        while i < len(word):
            k = max((m for m in range(1, len(word) - i + 1) if word[i : i + m] in text), default=1)
            n, i = n + 1, i + k
        return n

    pick = random.Random(6)
    for _ in range(500):
        word = "".join(pick.choice("abcdz") for _ in range(pick.randint(1, 9)))
        assert made.phrases(word) == plain(word), word


def test_languages(spark, odd, odd_rows, none):
    syllables = {"aa": "ba da ga".split(), "bb": "lu mu nu".split(), "cc": "schi stri tri".split()}
    pick = random.Random(2)
    word = lambda lang: "".join(pick.choice(syllables[lang]) for _ in range(pick.randint(1, 4)))
    rows = [(i, " ".join(word(lang) for _ in range(30)), lang) for i, lang in enumerate(list(syllables) * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = langid.learn_languages(docs)
    assert [name for name, _ in learned] == ["aa", "bb", "cc"]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify_languages(docs, learned).collect()}
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    assert held and all(got[i] == lang for i, _, lang in rows)
    found = langid.identify_languages(odd, learned)
    same_ids(found, odd_rows)
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found.collect()}
    assert by[1] == by[2] == by[3] == ("und", 0.0) and by[4][0] != "und" and 0 <= by[4][1] <= 1
    assert langid.learn_languages(none) == []
    assert {r["lang_pred"] for r in langid.identify_languages(odd, []).collect()} == {"und"}


def test_a_long_document_does_not_fill_a_language(spark):
    pick = random.Random(3)
    long = " ".join("".join(pick.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(2000))
    rows = [(i, long if i % 2 else f"xxshort{'abcdefghij'[i // 2 % 10]}{'abcdefghij'[i // 20]}", "aa") for i in range(60)]
    ((_, text),) = langid.learn_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"), most_letters=4000)
    learned = text.split()
    for i, t, _ in rows:
        if i % 2 == 0 and zlib.crc32(str(i).encode()) % 4 != 2:
            assert t in learned
    assert {w[0] for w in learned} >= set("abcmxyz") and 4000 <= sum(map(len, learned)) < 4010


# --- toxicity --------------------------------------------------------------------


def test_levenshtein_walk_finds_all_terms():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
            row = new
        return row[-1]

    pick = random.Random(9)
    make = lambda low, high: "".join(pick.choice("abc") for _ in range(pick.randint(low, high)))
    terms = {make(3, 15): pick.random() for _ in range(60)}
    lexicon = toxicity.Lexicon(terms)
    for _ in range(1500):
        word = make(1, 16)
        near = [(distance(word, t), -w, t) for t, w in terms.items() if distance(word, t) <= toxicity.edits_allowed(t)]
        want = (min(near)[2], min(near)[0]) if near else None
        if word in terms:
            want = (word, 0)
        assert lexicon.nearest(word) == want, word


def test_toxicity(spark, odd, odd_rows, none):
    pick = random.Random(1)
    clean = [f"wort{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(600):
        words = [pick.choice(clean) for _ in range(25)]
        toxic = i % 6 == 0
        for _ in range(2 * toxic):
            words.insert(pick.randint(0, 20), pick.choice(["dreckskerl", "vollpfosten", "mistvieh"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, marks)
    assert set(model.terms) == {"dreckskerl", "vollpfosten", "mistvieh"}
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, model).collect()}
    assert all((got[i] >= 0.3) == bool(t) for i, t in labels)
    score = model.scorer()
    assert score("du bist ein dreckskrl und ein vollpfostn du mistvieh") > 0.3
    assert score("er sagte das wort \"dreckskerl\" als zitat") < score("du dreckskerl")
    found = toxicity.score_toxicity(odd, model)
    same_ids(found, odd_rows)
    assert all(0 <= r["score"] <= 1 for r in found.collect())
    empty = toxicity.train(none, none.select("doc_id", F.lit(1).alias("toxic")))
    assert toxicity.score_toxicity(odd, empty).count() == len(odd_rows)
    assert toxicity.score_toxicity(none, model).count() == 0


def test_long_terms_take_two_edits():
    lexicon = toxicity.Lexicon({"vollpfostenkopf": 3.0, "mistvieh": 3.0})
    assert lexicon.nearest("volpfostnkopf") == ("vollpfostenkopf", 2)
    assert lexicon.nearest("vollpfxstenkxpf") == ("vollpfostenkopf", 2)
    assert lexicon.nearest("volpfstnkopf") is None and lexicon.nearest("mstvih") is None


def test_terms_that_clean_documents_quote_are_learned(spark):
    rows = [(i, f"wort{i % 7} " + ("mistvieh" if i % 3 == 0 or i % 40 == 1 else "tier")) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int")
    assert set(toxicity.train(docs, marks).terms) == {"mistvieh"}


def test_disguised_terms():
    lexicon = toxicity.Lexicon({"idiot": 4.0, "worthless": 3.0, "stupid": 2.0, "vollpfostenkopf": 5.0})
    for text, term in {
        "you id1ot": "idiot", "a wor_thless thing": "worthless", "so st*pid, no": "stupid", "x,id1ot": "idiot", "id1ot/und": "idiot",
        "der v*llpf*stenkopf": "vollpfostenkopf", "der voll--pfostenkopf": "vollpfostenkopf", "a\u200bb wor\u200bthless": "worthless",
    }.items():
        x = dict(zip(toxicity.FEATURES, toxicity.features(text, lexicon)))
        assert x["near"] == pytest.approx(np.log(2)) and x["exact"] == 0, text
        edits = 2 if term == "vollpfostenkopf" else 1
        assert x["strongest"] == pytest.approx(lexicon.terms[term] / (1 + edits)), text
    for text in ("id ot", "id12ot", "it's a well-known id", "st\npid", "i-d-i-o-t"):
        assert toxicity.features(text, lexicon) == [1.0] + [0.0] * 7, text
    x = dict(zip(toxicity.FEATURES, toxicity.features("stupid-s", lexicon)))
    assert x["exact"] == pytest.approx(np.log(2)) and x["near"] == 0  # counted once


# --- licenses --------------------------------------------------------------------


def test_licenses(spark, odd, odd_rows, none):
    texts = {
        1: "This is under the MIT License, not the mit\nlicense.", 2: "Licensed  under the\nApache License -- Version 2.0",
        3: "GNU General public LICENSE", 4: "licence", 5: "Licensed under CC BY-NC 4.0.", 6: None, 7: "Ünder MİT license",
        8: "word " * 100 + "Redistribution and use in source and binary forms, with or without modification, are permitted",
        9: "redistribution and use " + "word " * 100 + "in source and binary forms with or without modification are permitted",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_scan.scan_licenses(docs).collect()}
    places = {i: [(p["label"], p["start"]) for p in r["places"]] for i, r in got.items()}
    assert places[1] == [("mit", 4), ("mit", 8)] and places[2] == [("apache", 3)] and places[3] == [("gpl", 1)]
    assert places[4] == places[6] == places[7] == []
    assert "apache" in got[2]["found"] and got[5]["found"] == ["cc-by-nc"] and got[5]["score"] == 1.0
    assert got[8]["found"] == ["bsd"] and got[9]["found"] == [] and got[9]["score"] == 0.0
    assert got[6]["n_words"] == 0
    found = license_scan.scan_licenses(odd)
    same_ids(found, odd_rows)
    assert found.columns == ["doc_id", "n_words", "places", "found", "score"]
    assert license_scan.scan_licenses(none).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- languages side by side ------------------------------------------------------


def test_phrases_side_by_side():
    """All stretches in one table give the phrases of each automaton alone, over blanks."""
    for seed in range(3):
        pick = random.Random(seed)
        made = lambda n, letters: " ".join("".join(pick.choice(letters) for _ in range(n)).split())
        samples = [(name, made(300, letters)) for name, letters in (("a", "abcd "), ("b", "cdef "), ("c", "aefg "))]
        automata = [langid.SuffixAutomaton(text) for _, text in samples]
        parser = langid.CrossParser(samples)
        texts = [made(pick.randint(0, 500), "abcdefghz ") for _ in range(100)] + [""]
        assert parser.count(texts).tolist() == [[a.phrases(t) for a in automata] for t in texts]
        long = made(5_000, "abcdef ")
        parts = [long[at : at + langid.STRETCH] for at in range(0, len(long), langid.STRETCH)]
        assert parser.count([long])[0].tolist() == [sum(a.phrases(p) for p in parts) for a in automata]


def test_prediction_is_the_smallest_entropy(monkeypatch):
    monkeypatch.setattr(langid, "PIECE", 2 * langid.STRETCH)
    monkeypatch.setattr(langid, "PIECES", 3)
    pick = random.Random(5)
    made = lambda n, words: " ".join(pick.choice(words.split()) for _ in range(n))
    kinds = {"xx": "the cat sat on a mat", "yy": "die katze lag auf der matte", "zz": "le chat dort sur un tapis"}
    samples = [(name, made(200, words)) for name, words in kinds.items()]
    parser = langid.CrossParser(samples)
    texts = [made(pick.choice([1, 5, 40, 900]), kinds[name]) for name in list(kinds) * 10] + [None, "", " 12 !", "Ω"]
    for text, (name, score) in zip(texts, parser.predict(texts)):
        read = " ".join(langid.letters_of(text or ""))
        if not read:
            assert (name, score) == ("und", 0.0)
            continue
        parts = [read[at : at + langid.STRETCH] for at in range(0, len(read), langid.STRETCH)]
        entropy = [sum(map(langid.SuffixAutomaton(s).phrases, parts)) * np.log2(len(s) + 2) / len(read) for _, s in samples]
        assert name == samples[int(np.argmin(entropy))][0]
        assert score == pytest.approx(1 / sum(np.exp(-4 * (e - min(entropy))) for e in entropy))


def test_a_larger_bound_learns_no_less():
    words = [f"word{i}" for i in range(500)]
    assert langid._stretches(words, 10**9) == [" ".join(words[at : at + 25]) for at in range(0, 500, 25)]
    some = langid._stretches(words, 900)
    assert 900 <= sum(len(w) for s in some for w in s.split()) < 900 + 25 * 7 and len({s for s in some}) == len(some)
    assert max(words.index(s.split()[0]) for s in some) > 300 and langid._stretches([], 5) == []


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.identify_languages(docs, langid.learn_languages(docs), keep=["doc_id", "lang"])
    held = [r for r in found.collect() if r["lang"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held) > 100
