import re
from collections import Counter

from kinspark.llm import quality_rules as Q


def model(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = list(zip(w, w[1:], w[2:]))
    often = Counter(grams)
    covered = {j for i, g in enumerate(grams) if often[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(w), sum(map(len, w)), sum(c in Q.SYMBOLS for c in text), len(lines) - len(set(lines)), len(covered)


def check(docs):
    got = {}
    for r in Q.quality_rules(docs).collect():
        got.setdefault((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words), []).append(r)
    want = Counter((r.doc_id, *model(r.text)) for r in docs.collect())
    assert {k: len(v) for k, v in got.items()} == want
    for k, rows in got.items():
        failed = k[1] < 50 or 100 * k[5] > 50 * k[1]
        assert all(r.base_failed == failed and not (failed and r.kept) for r in rows)


def test_counts_equal_model(awkward, small_docs):
    check(awkward)
    check(small_docs)


def test_empty_table(no_rows):
    assert Q.quality_rules(no_rows).collect() == []
    assert Q.kept_documents(no_rows).columns == no_rows.columns


def test_kept_documents_keep_their_columns(awkward):
    kept = Q.kept_documents(awkward)
    assert kept.schema == awkward.schema
    want = Counter(r.doc_id for r in Q.quality_rules(awkward).where("kept").collect())
    assert Counter(r.doc_id for r in kept.collect()) == want


def test_verdict_follows_labels(spark):
    d = "/root/testdata/sf0.01/"
    out = Q.quality_rules(spark.read.parquet(d + "documents.parquet")).where("n_words >= 50")
    both = out.join(spark.read.parquet(d + "labels.parquet"), "doc_id").groupBy("quality", "kept").count().collect()
    n = {(r["quality"], r["kept"]): r["count"] for r in both}
    assert n.get((1, False), 0) == 0 and n.get((0, True), 0) <= 0.02 * n[0, False]


def test_no_python_in_the_plan(small_docs):
    plan = Q.quality_rules(small_docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_rule_table_compiles():
    rules = [Q.Rule("a", "n_words / n_lines", 2, None), Q.Rule("b", "n_symbols / n_words", None, 0.5)]
    assert Q.compile_rules(rules) == "n_words >= 2D * n_lines AND n_symbols <= 0.5D * n_words"
    assert Q.compile_rules([]) == "true"


CLEAN = {
    "ru": "Утром он вышел из дома и пошёл по улице к реке, где уже стояли люди. Вода была холодной, но никто не уходил, "
    "потому что все ждали большую лодку с товаром. Старый рыбак сказал, что она придёт к полудню, а дети смеялись и бегали по берегу. "
    "Потом подул ветер, и на воде появились волны, которые медленно шли к камням и снова возвращались назад, как будто играли друг с другом.",
    "pl": "Rano wyszedł z domu i poszedł ulicą w stronę rzeki, gdzie stali już ludzie. Woda była zimna, ale nikt nie odchodził, "
    "bo wszyscy czekali na dużą łódź z towarem. Stary rybak powiedział, że przypłynie do południa, a dzieci śmiały się i biegały po brzegu. "
    "Potem zerwał się wiatr i na wodzie pojawiły się fale, które powoli szły do kamieni i znowu wracały, jakby bawiły się ze sobą przez cały dzień.",
    "hi": "सुबह वह घर से निकला और नदी की ओर चल पड़ा जहाँ लोग पहले से खड़े थे। पानी ठंडा था लेकिन कोई नहीं जा रहा था क्योंकि सब बड़ी नाव की "
    "प्रतीक्षा कर रहे थे। बूढ़े मछुआरे ने कहा कि वह दोपहर तक आ जाएगी और बच्चे हँसते हुए किनारे पर दौड़ रहे थे। फिर हवा चली और पानी पर लहरें "
    "दिखाई दीं जो धीरे धीरे पत्थरों तक जातीं और फिर लौट आतीं मानो आपस में खेल रही हों।",
    "ko": "아침에 그는 집을 나와 사람들이 이미 서 있는 강 쪽으로 걸어갔다. 물은 차가웠지만 모두가 짐을 실은 큰 배를 기다리고 있었기 때문에 아무도 "
    "떠나지 않았다. 늙은 어부는 배가 정오까지 올 것이라고 말했고 아이들은 웃으며 강가를 뛰어다녔다. 그러다 바람이 불었고 물 위에 물결이 나타나 "
    "천천히 돌까지 갔다가 다시 돌아왔는데 마치 서로 놀고 있는 것 같았다. 저녁이 되자 배가 왔고 사람들은 짐을 내리며 노래를 불렀다. 그는 집으로 돌아가 "
    "어머니에게 모든 것을 이야기했다.",
    "kk": "Таңертең ол үйден шығып, адамдар тұрған өзенге қарай жүрді. Су суық болды, бірақ ешкім кетпеді, өйткені бәрі жүк тиеген үлкен қайықты "
    "күтті. Кәрі балықшы оның түске дейін келетінін айтты, ал балалар күліп, жағада жүгіріп жүрді. Сосын жел тұрып, суда толқындар пайда болды, "
    "олар тастарға баяу жетіп, қайтадан кері оралды, бір-бірімен ойнап жүргендей көрінді. Кешке қайық келіп, адамдар ән айтып жүкті түсірді.",
    "vi": "Buổi sáng anh ấy ra khỏi nhà và đi về phía bờ sông nơi mọi người đã đứng đợi. Nước rất lạnh nhưng không ai rời đi vì tất cả đều chờ "
    "chiếc thuyền lớn chở hàng. Ông lão đánh cá nói rằng thuyền sẽ đến trước buổi trưa, còn lũ trẻ cười đùa chạy dọc bờ sông.",
}


def test_clean_prose_of_many_languages_is_kept(spark):
    docs = spark.createDataFrame(sorted(CLEAN.items()), "lang string, text string").selectExpr("monotonically_increasing_id() AS doc_id", "*")
    assert sorted(r.lang for r in Q.kept_documents(docs).collect()) == sorted(CLEAN)


def test_junk_still_fails(spark):
    junk = [" ".join(f"{(i * 7919) % 99991:x}q{i:o}" for i in range(120)), " ".join("zxkq vbnm wrtp"[i % 9 :] + str(i) for i in range(90))]
    junk += ["### $$$ %%% " * 40, " ".join("漢#" * (i % 3 + 1) + f"$k{i}" for i in range(80)), " ".join(f"кц{i}ъы{i * i}" for i in range(80))]
    docs = spark.createDataFrame(enumerate(junk), "doc_id long, text string")
    assert [r.doc_id for r in Q.quality_rules(docs).collect() if r.kept] == []


def test_letters_of_other_scripts(spark):
    texts = ["abc é ß ł", "αβγ abc", "漢字 😀", "हिन्दी", "한국어", "әңғ", "", None, "ạb", "дом"]
    rows = Q.measures(spark.createDataFrame(enumerate(texts), "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_other_letters for r in rows} == dict(enumerate([0, 3, 2, 6, 3, 3, 0, 0, 1, 0]))
