"""Junk, rare shapes and collisions that operators once left undone."""

import string

import corpus_pipeline as P
import numpy as np
import pyarrow as pa
from conftest import SMALL

from tillwise.llm import blocks, fertility, fm_index, recompression, url_filter, vocabulary

PROSE = {
    "en": "All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience and should act towards one another in a spirit of brotherhood.",
    "vi": "Tất cả mọi người sinh ra đều được tự do và bình đẳng về nhân phẩm và quyền lợi. Mọi con người đều được tạo hoá ban cho lý trí và lương tâm và cần phải đối xử với nhau trong tình anh em.",
    "tr": "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler.",
    "ru": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны поступать в отношении друг друга в духе братства.",
    "kk": "Барлық адамдар тумысынан азат және қадір-қасиеті мен құқықтары тең болып дүниеге келеді. Адамдарға ақыл-парасат, ар-ождан берілген, сондықтан олар бір-бірімен туыстық, бауырмалдық қарым-қатынас жасаулары тиіс.",
    "el": "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα. Είναι προικισμένοι με λογική και συνείδηση, και οφείλουν να συμπεριφέρονται μεταξύ τους με πνεύμα αδελφοσύνης.",
    "he": "כל בני האדם נולדו בני חורין ושווים בערכם ובזכויותיהם. כולם חוננו בתבונה ובמצפון, לפיכך חובה עליהם לנהוג איש ברעהו ברוח של אחווה.",
    "hi": "सभी मनुष्यों को गौरव और अधिकारों के मामले में जन्मजात स्वतन्त्रता और समानता प्राप्त है। उन्हें बुद्धि और अन्तरात्मा की देन प्राप्त है और परस्पर उन्हें भाईचारे के भाव से बर्ताव करना चाहिए।",
    "ko": "모든 인간은 태어날 때부터 자유로우며 그 존엄과 권리에 있어 동등하다. 인간은 천부적으로 이성과 양심을 부여받았으며 서로 형제애의 정신으로 행동하여야 한다.",
    "zh": "人人 生而 自由 在 尊严 和 权利 上 一律 平等 他们 赋有 理性 和 良心 并应 以 兄弟 关系 的 精神 相 对待",
    "ka": "ყველა ადამიანი იბადება თავისუფალი და თანასწორი თავისი ღირსებითა და უფლებებით. მათ მინიჭებული აქვთ გონება და სინდისი და ერთმანეთის მიმართ უნდა იქცეოდნენ ძმობის სულისკვეთებით.",
}


def random_words(letters, n=300, low=3, high=9, seed=4):
    rng = np.random.default_rng(seed)
    return ["".join(rng.choice(list(letters), rng.integers(low, high + 1))) for _ in range(n)]


def kept(texts):
    out = fertility.judge(pa.array(texts), vocabulary.path("piece_bpe_32k.model"), fertility.BANDS)
    assert not out["base_failed"].any()
    return out["kept"].tolist()


def symbol_junk(text):
    marks = ("***", "&&&", "%%%", "$$$", "###")
    return " ".join(w + marks[i % 5] for i, w in enumerate(text.split()))


def test_fertility_rejects_planted_junk_of_every_script_and_keeps_prose():
    assert dict(zip(PROSE, kept(list(PROSE.values())), strict=True)) == dict.fromkeys(PROSE, True)
    assert not any(kept([symbol_junk(text) for text in PROSE.values()]))
    assert not any(kept([" | ".join(text.split()) for text in PROSE.values()]))
    # letters that an own band parts from prose
    cyrillic = [chr(c) for c in range(0x430, 0x450)]
    hanzi, hangul = [chr(c) for c in range(0x4E00, 0x9FA6)], [chr(c) for c in range(0xAC00, 0xD7A4)]
    for letters in (string.ascii_lowercase, string.ascii_letters + string.digits, cyrillic, hanzi, hangul):
        assert kept([" ".join(random_words(letters))]) == [False]
    digits = [random_words(string.digits), random_words(string.digits, low=1, high=1), random_words("0123456789.,-")]
    assert not any(kept([" ".join(words) for words in digits]))


def test_fertility_keeps_the_clean_labelled_rows_and_drops_most_junk(spark):
    """On a table other than the one whose labelled rows gave the bound of marks."""
    folder = SMALL.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    found = fertility.quality(spark.read.parquet(f"{folder}/documents.parquet").join(labels, "doc_id", "left_semi"))
    judged = found.where("NOT base_failed").join(labels, "doc_id").select("quality", "kept").collect()
    clean, junk = ([r.kept for r in judged if r.quality == q] for q in (1, 0))
    assert sum(clean) >= 0.999 * len(clean) and sum(junk) <= 0.1 * len(junk)


def plain_measures(text):
    """Tokens per word and letters per token, word by word, with both vocabularies."""
    import base64

    import public_tokenizers
    import sentencepiece
    import tiktoken

    pieces = sentencepiece.SentencePieceProcessor(model_file=vocabulary.path("piece_bpe_32k.model"))
    with open(vocabulary.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    tokens = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    words = text.split()
    firsts = [bytes([b]) for b in [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC3, 0xE2), *range(0xE3, 0xF0)]]
    letters = [sum(c.encode()[:1] in firsts for c in w) for w in words]
    counts = [sum(len(pieces.encode(w)) for w in words), sum(len(tokens.encode_ordinary(" " + w)) for w in words)]
    with_letter = sum(n > 0 for n in letters)
    return sum(counts) / (2 * with_letter), sum(sum(letters) / n for n in counts) / 2


def test_fertility_is_that_of_two_vocabularies():
    texts = [f(t) for t in PROSE.values() for f in (str, symbol_junk)]
    out = fertility.judge(pa.array(texts), vocabulary.path("piece_bpe_32k.model"), fertility.BANDS)
    want = [plain_measures(t) for t in texts]
    assert np.allclose(out["tokens_per_word"], [w[0] for w in want])
    assert np.allclose(out["letters_per_token"], [w[1] for w in want])


def test_fertility_alone_rejects_words_with_marks_and_keeps_prose():
    """Long texts of five scripts, with all bands but that of fertility wide open."""
    for lang in ("vi", "tr", "ru", "kk", "el", "he", "zh"):
        text = " ".join([PROSE[lang]] * 4)
        out = fertility.judge(pa.array([text, symbol_junk(text)]), vocabulary.path("piece_bpe_32k.model"), fertility.BANDS)
        assert ["fertility" in r.split(",") for r in out["reasons"]] == [False, True], lang


def test_kept_follows_the_bands_document_by_document(spark):
    """The verdict against a plain reading of the bands, from the reported measures."""
    found = fertility.quality(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()
    for r in found:
        band, long = fertility.BANDS[r.script], r.n_tokens >= fertility.BANDS[r.script].entropy_tokens
        want = set()
        if r.base_failed:
            want.add("base")
        if not band.least_chars <= r.chars_per_token <= band.most_chars:
            want.add("chars")
        if r.byte_share > band.most_bytes:
            want.add("bytes")
        if long and r.token_entropy < band.least_entropy:
            want.add("entropy")
        if long and r.tokens_per_word > band.most_per_word and r.letters_per_token < band.least_letters:
            want.add("fertility")
        reasons = set(filter(None, r.reasons.split(",")))
        assert reasons - {"whole", "marks", "digits"} == want and r.kept == (not reasons)
    assert any("fertility" in r.reasons for r in found)


UNWANTED = [
    "mega-jackpots.example.net", "texas-pokers.test", "m.onlinecasinos24.info", "blog.adult-x.example.net",
    "warez-archive.net", "super-bookmakers.example.de", "fast-payday.example.com",
]
CLEAN = [
    "www.tionble.example.org", "blog.ingther.example.net", "stationery.co.uk", "www.keramik-werkstatt.de",
    "shop.lanterns.info", "m.tugboats.net", "www.meadows.example.org", "violins.example.io", "biblioteca.example.com",
]
LONG_PATH = "/library/school/museum/history/garden/recipes/travel/science" * 4 + "/index.html"


def test_url_filter_judges_hosts_it_was_not_fitted_on(spark):
    """Whatever path they have, however long."""
    labelled = url_filter.labelled_urls(spark).cache()
    known = {r.url.split("/")[2] for r in labelled.collect()}
    assert not known & {*UNWANTED, *CLEAN}
    paths = ("", "/en/7", "/de/archive/1234.html?page=2", LONG_PATH)
    pages = [(f"{h} {k}", f"https://{h}{path}") for h in UNWANTED + CLEAN for k, path in enumerate(paths)]
    got = url_filter.judge_urls(spark.createDataFrame(pages, "page_id string, url string"), labelled, rules=())
    got = {r.page_id: r for r in got.collect()}
    wrong = [i for i, r in got.items() if (r.verdict == "block") != (r.host in UNWANTED)]
    assert len(got) == 4 * 16 and len(wrong) <= 0.1 * len(got), wrong
    # no path clears a host
    assert all(got[f"{h} {k}"].score >= got[f"{h} 0"].score - 0.02 for h in UNWANTED for k in (1, 2, 3))


def test_labelled_urls_have_no_host_of_the_pages(spark):
    pages = spark.read.parquet(f"{SMALL.replace('0.001', '0.1')}/pages.parquet").select("url").collect()
    names = {part for r in pages for part in r.url.split("/")[2].split(".")} - {"example", "com", "net", "org", "www", "m", "blog"}
    ordinary = url_filter.labelled_urls(spark).where("label = 0").collect()
    assert not names & {part for r in ordinary for part in r.url.split("/")[2].split(".")}


def test_url_filter_samples_every_label_whatever_the_order_of_the_rows(spark):
    made = [(f"https://a{i}.test/", 0) for i in range(3000)] + [(f"https://b{i}.test/", 1) for i in range(60)]
    frames = [spark.createDataFrame(x, "url string, label int") for x in (made, made[::-1])]
    samples = [{tuple(r) for r in url_filter.training_sample(x, 200).collect()} for x in frames]
    assert samples[0] == samples[1]
    labels = [label for _, label in samples[0]]
    assert labels.count(1) == 60 and 60 < labels.count(0) < 140
    weights = [url_filter.fit(x, rounds=2, size=200) for x in frames]
    assert weights[0] == weights[1] and any(weights[0])


def test_benchmark_items_without_id_are_hit_and_cut_but_not_listed(spark, tmp_path):
    passage = [f"q{i}" for i in range(14)]
    bench = spark.createDataFrame([(None, " ".join(passage)), (7, "alpha beta"), (None, "Gamma")], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    made = [(1, "head " + " ".join(passage) + " tail"), (2, "alpha beta and gamma"), (3, "nothing here")]
    docs = spark.createDataFrame(made, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = fm_index.query(spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.n_hit, r.n_items, r.contaminated) for r in found} == {
        (1, 14, 0, True), (2, 3, 1, True), (3, 0, 0, False),
    }
    for size in (10, fm_index.BLOCK_BYTES):
        blocks = fm_index.benchmark_blocks(bench, block_bytes=size)
        got = {r.doc_id: (r.n_hit, r.items) for r in fm_index.contamination(docs, blocks).collect()}
        assert got == {1: (14, []), 2: (3, ["7"]), 3: (0, [])}
    left = {r.doc_id: r.text for r in P.benchmark_decontamination(spark, docs, str(tmp_path)).collect()}
    assert left == {1: "head  tail", 2: " and ", 3: "nothing here"}


def test_store_of_words_forgets_the_oldest_and_keeps_ids_right():
    import numpy as np
    import pyarrow as pa

    from tillwise.llm import vocabulary
    from tillwise.llm.text import SPACED, Words, texts_of

    asked = []

    def encode(words):
        asked.extend(words)
        return [[ord(c) for c in w] for w in words]

    store = vocabulary.WordIds(encode, kept_bytes=40_000)
    for step in range(60):
        texts = [" ".join(f"w{(step * 40 + i) % 1500}" for i in range(200)), "", "always here"]
        words = Words(*texts_of(pa.array(texts, pa.large_string())), SPACED)
        ids, size = store(words)
        wanted = [w for t in texts for w in t.split()]
        assert size.tolist() == [len(w) for w in wanted]
        assert ids.tolist() == [ord(c) for w in wanted for c in w]
        assert store.young.bytes + store.old.bytes < 120_000
    assert asked.count("always") == 1 and max(map(asked.count, ("w3", "w700"))) > 1
    assert store(Words(np.zeros(0, np.uint8), np.zeros(1, np.int64), SPACED))[0].tolist() == []


def test_capitals_change_no_ids_but_those_of_special_names(spark):
    from tokenizers import Tokenizer

    from tillwise.llm import packing, vocabulary

    texts = ["The CAT sat", "a <|ENDOFTEXT|> b <|endoftext|> C", "ÉTÉ ΣΑΣ Straße", "ALL CAPS ALL caps"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    import zlib

    import numpy as np

    plain = Tokenizer.from_file(vocabulary.path("word_bpe_49k.json"))
    want = {(i, zlib.crc32(np.array(plain.encode(t, add_special_tokens=False).ids + [1], "<u4").tobytes())) for i, t in enumerate(texts)}
    assert {(r.doc_id, r.ids_crc32) for r in packing.pack(docs).collect()} == want


def test_windows_with_one_hash_are_told_apart_by_the_second(monkeypatch):
    """All windows collide in the first 64 bits; only the repeated passage goes."""
    real = recompression.window_hash

    def colliding(hashes, size, seed=0):
        out = real(hashes, size, seed)
        return out & np.uint64(0) if seed == 1 else out

    monkeypatch.setattr(recompression, "window_hash", colliding)
    passage = [f"p{i}" for i in range(15)]
    texts = [passage + [f"a{i}" for i in range(20)], [f"b{i}" for i in range(20)] + passage, [f"c{i}" for i in range(30)]]
    units, rows = [], []
    for number, words in enumerate(texts):
        unit = recompression.Unit(pa.RecordBatch.from_pylist([{"doc_id": number, "text": " ".join(words)}]), 13)
        unit.anchor_keys()
        unit.window_keys(np.ones(len(unit.names), bool))
        assert len(unit.keys) == len(words) - 12 and set(unit.keys.tolist()) == {0}
        rows.append(
            {
                "unit": number, "bucket": 0, "keys": blocks.packed_sorted(unit.keys),
                "second": blocks.packed(unit.second), "least": blocks.packed(unit.least.view(np.uint64)),
            }
        )
        units.append(unit)
    answers = {a["unit"]: a for a in recompression._earlier(pa.Table.from_pylist(rows)).to_pylist()}
    for number, unit in enumerate(units):
        gone = unit.removed(blocks.joined_bits([answers[number]], np.array([0, len(unit.keys)])))
        assert np.flatnonzero(gone).tolist() == (list(range(20, 35)) if number == 1 else [])


def test_hashing_a_unit_takes_memory_for_a_part_of_it_only():
    import tracemalloc

    import numpy as np

    from tillwise.llm.recompression import anchors
    from tillwise.llm.text import SPACED, Words

    text = np.frombuffer(b"".join(b"word%07d " % (i * i % 9_999_991) for i in range(250_000)), np.uint8)
    words = Words(text, np.arange(0, len(text) + 1, len(text) // 500), SPACED)
    tracemalloc.start()
    hashes = words.hash
    of_hashes = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    anchors(words, hashes)
    of_anchors = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert of_hashes < 6 * len(text) and of_anchors < 14 * len(text)


def test_words_hash_alike_wherever_the_parts_are_cut(monkeypatch):
    import numpy as np

    from tillwise.llm import recompression, text
    from tillwise.llm.text import SPACED, Words, texts_of

    rows = ["a bb " + "c" * 300 + " a bb", None, "", " ", "x" * 50, *["one two  three four one two " * 9] * 7]
    words = Words(*texts_of(pa.array(rows)), SPACED)
    whole = words.hash, words.second_hash, *recompression.anchors(words, words.hash)
    for size in (1, 7, 64):
        monkeypatch.setattr(text, "HASHED_BYTES", size)
        monkeypatch.setattr(recompression, "ANCHORED_WORDS", size)
        cut = words.hash, words.second_hash, *recompression.anchors(words, words.hash)
        assert all(np.array_equal(a, b) for a, b in zip(whole, cut, strict=True))


def test_a_unit_takes_memory_for_a_part_of_its_texts_only():
    import tracemalloc

    def text(doc):
        return "".join(f"word{k * k % 9_999_991:07d} " for k in range(doc * 500, doc * 500 + 500))

    batch = pa.RecordBatch.from_pylist([{"doc_id": doc, "text": text(doc)} for doc in range(700)])
    unit = recompression.Unit(batch.slice(0, 1), 13)
    unit.anchor_keys()
    tracemalloc.start()
    unit = recompression.Unit(batch, 13)
    unit.anchor_keys()
    of_anchors = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    unit.window_keys(unit.names % np.uint64(10) == 0)
    of_windows = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert unit.counts.tolist() == [500] * 700 and len(unit.keys)
    assert of_anchors < 8 * batch.nbytes and of_windows < 6 * batch.nbytes, (of_anchors / batch.nbytes, of_windows / batch.nbytes)


def test_a_unit_finds_the_same_wherever_its_parts_are_cut(monkeypatch):
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [
        {"doc_id": 3, "text": "a b " + passage}, {"doc_id": None, "text": None}, {"doc_id": 1, "text": passage + " c d"},
        {"doc_id": 2, "text": "x " * 40}, {"doc_id": 1, "text": "y " + passage}, {"doc_id": None, "text": "x " * 50},
        {"doc_id": 5, "text": ""}, {"doc_id": 4, "text": "too short"},
    ]
    batch = pa.RecordBatch.from_pylist(rows)

    def found():
        unit = recompression.Unit(batch, 13)
        unit.anchor_keys()
        names = unit.names, unit.several
        unit.window_keys(np.zeros(len(unit.names), bool))
        gone = unit.removed(np.zeros(len(unit.keys), bool))
        return *names, unit.keys, unit.second, unit.least, gone, *recompression._kept_texts(unit, gone), unit.counts

    whole = found()
    assert whole[-2].tolist() == [20, 0, 0, 0, 0, 50, 0, 0]
    for size in (1, 100, 200):
        monkeypatch.setattr(recompression, "PART_BYTES", size)
        assert all(np.array_equal(a, b) for a, b in zip(whole, found(), strict=True))


def test_workers_get_few_units_at_a_time(spark, monkeypatch):
    """Units are handed over one by one under a limit below their size; the session's own limit comes back."""
    key, given = "spark.sql.execution.arrow.maxBytesPerBatch", []
    real = blocks.stage

    def staged(frame, label):
        given.append(spark.conf.get(key))
        return real(frame, label)

    monkeypatch.setattr(blocks, "stage", staged)
    monkeypatch.setattr(blocks, "BATCH_BYTES", 1)
    monkeypatch.setattr(blocks, "UNIT_BYTES", 1)
    before = spark.conf.get(key)
    passage = " ".join(f"p{i}" for i in range(20))
    made = [(doc, f"{doc} {passage} end{doc}") for doc in range(30)]
    docs = spark.createDataFrame(made, "doc_id long, text string").coalesce(2)
    left = {r.doc_id: r.n_removed for r in recompression.repeats(docs).collect()}
    assert left == {doc: 20 if doc else 0 for doc in range(30)}
    assert given == ["1"] * 3 and spark.conf.get(key) == before
