import os
import random

import pytest
from pyspark.sql import functions as F

from tamizal.llm import bpe, packing, sentences
from tamizal.session import table

TEXTS = ["", None, " ", "\n\n", "hello hello world", "aaaaaaaaaaaa", "¿Qué garantía rige, p. ej. 12 meses?", "<|endoftext|> and <s>", "標本 は 不適合です。", "ó é", "👩🏽‍⚕️", "tab\tand\r\nbreak  ", "It's we'll I'd", "x" * 3000 + " 9" * 3000, "a​ b"]


@pytest.fixture(scope="module")
def encoder():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(bpe.default_vocabulary())
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_library(spark, encoder):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS + TEXTS)]
    d = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = {r["doc_id"]: r["ids"] for r in bpe.encode(d).collect()}
    assert got == {i: encoder(t) for i, t, _ in rows}
    sizes = {r["doc_id"]: r["n_tokens"] for r in bpe.encode(d, counts_only=True).collect()}
    assert sizes == {i: len(x) for i, x in got.items()}
    assert bpe.encode(d.limit(0)).count() == 0


def test_ids_of_documents(spark, data, encoder):
    d = table(spark, data, "documents")
    texts = {r["doc_id"]: r["text"] for r in d.select("doc_id", "text").collect()}
    got = {r["doc_id"]: r["ids"] for r in bpe.encode(d).collect()}
    assert got == {i: encoder(t) for i, t in texts.items()}


def test_blocks_do_not_change_ids(spark, encoder, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 40)
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    d = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert {r["doc_id"]: r["ids"] for r in bpe.encode(d).collect()} == {i: encoder(t) for i, t in rows}


def test_pack_histogram_places_everything():
    rnd = random.Random(5)
    for _ in range(30):
        counts = {rnd.randint(1, 100): rnd.randint(1, 500) for _ in range(20)}
        patterns = packing.pack_histogram(counts, 100)
        placed = {}
        for n, lengths in patterns:
            assert sum(lengths) <= 100
            for x in lengths:
                placed[x] = placed.get(x, 0) + n
        assert placed == counts


@pytest.mark.parametrize("capacity", [16, 2048])
def test_pack(spark, capacity):
    rnd = random.Random(capacity)
    rows = [(i, rnd.choice([0, None, 1, 7, 7, 7, rnd.randint(1, 5 * capacity)])) for i in range(3000)]
    d = spark.createDataFrame(rows, "doc_id long, n int").withColumn("contenedor", F.lit("clash"))
    got = packing.pack(d, key="doc_id", size="n", capacity=capacity).collect()
    room, parts = {}, {}
    for r in got:
        parts.setdefault(r["doc_id"], []).append((r["pieza"], r["inicio"], r["largo"]))
        if r["contenedor"] is None:
            assert r["largo"] == 0
        else:
            room.setdefault(r["contenedor"], []).append((r["posicion"], r["largo"]))
    for i, n in rows:
        p = sorted(parts[i])
        assert sum(x[2] for x in p) == (n or 0) and all(x[2] == capacity for x in p[:-1])
        assert [x[1] for x in p] == [k * capacity for k in range(len(p))]
    for each in room.values():
        at = 0
        for pos, size in sorted(each):
            assert pos == at
            at += size
        assert at <= capacity
    total = sum(n or 0 for _, n in rows)
    assert -(-total // capacity) <= len(room) <= 1.2 * -(-total // capacity) + 1
    assert packing.pack(d.limit(0), key="doc_id", size="n", capacity=capacity).count() == 0


@pytest.fixture(scope="module")
def model(spark, data):
    return sentences.Model([tuple(r) for r in sentences.learn(table(spark, data, "documents")).collect()])


CASES = [
    ["Se incluyen guantes, batas, etc. dentro del plazo.", "El Ing. C. Denralumvi manifestó: «La muestra no cumple. Debe reemplazarse.» y dejó constancia."],
    ["El contrato fue suscrito con Narxa Celmi S.A.S.", "Se declara desierto el proceso."],
    ["La oferta de Narxa S.A. fue calificada con 3,5 puntos (ver núm. 5.2.1).", "¿Quién firma el acta?!", "La entidad no lo precisa."],
    ["Hubo 3 oferentes... ninguno presentó la garantía completa.", "no se aceptarán ofertas parciales bajo ninguna circunstancia.", "¡Atención a la fecha límite!"],
    ["Los anexos No. 3 y No. 7 faltaban, según el art. 71.", "375 unidades fueron entregadas el 8.10.2025.", "El portal www.celmi.invalid/proc?id=3 estará disponible."],
    ["Mr. Lumzucor and Dr. Quinpranar signed at 4:30 p.m. on behalf of the committee.", "Can the supplier offer one, e.g. one made of steel?"],
    ["第843包因无有效报价而废标。", "评审委员会答复:「样品不合格。请更换。」并记录在案。", "是否接受同等产品？"],
    ["पूर्ति की अवधि 292 दिन है।", "डॉ. तरकेल ने हस्ताक्षर किए।", "क्या स्वीकार होगा?"],
    ["ราคากลางเป็นเงิน 47.82 บาทไม่รวมภาษี", "ไม่รับข้อเสนอที่ยื่นล่าช้าทุกกรณี"],
    ["وقّع د. ترقول محضر الجلسة باسم اللجنة.", "هل يمكن تقديم منتج مماثل؟", "لن تقبل العروض المتأخرة!"],
    ["Dr. Densolpel hat am 3. Mai das Protokoll unterschrieben.", "Darf z. B. ein gleichwertiges Produkt angeboten werden?"],
]


@pytest.mark.parametrize("parts", CASES, ids=range(len(CASES)))
def test_sentences(model, parts):
    for sep in (" ", "  ", "\n\n", "\r\n\r\n"):
        text = f" {sep.join(parts)}\n"
        assert [text[a:b] for a, b in sentences.sentences(text, model)] == parts


@pytest.mark.parametrize("head", ["https://celmi.invalid/", "www.celmi.invalid/", "HTTPS://celmi.invalid/"])
@pytest.mark.parametrize("size", [10, 90, 3500])
@pytest.mark.parametrize("tail", ["anexo.Pdf", "busca?Proceso=3", "uno!Dos"])
def test_long_addresses_are_not_cut(model, head, size, tail):
    parts = [f"Consulte {head}{'ab/' * size}{tail} antes del cierre.", "El comité respondió."]
    text = " ".join(parts)
    assert [text[a:b] for a, b in sentences.sentences(text, model)] == parts


@pytest.mark.parametrize("size", [10, 39, 41, 90, 10_000])
def test_cuts_do_not_depend_on_the_length_of_words(model, size):
    parts = ["La clave es " + "x" * size + ".", "Consta en el acta " + "Y" + "y" * size + ".", "W" + "w" * size + " fue la firma.", "Fin"]
    text = " ".join(parts)
    assert [text[a:b] for a, b in sentences.sentences(text, model)] == parts
    tight = ["Se entregó " + "x" * size + ".", "Otra" + "o" * size + " frase sigue."]
    assert [x for a, b in sentences.sentences("".join(tight), model) for x in ["".join(tight)[a:b]]] == tight
    items = f"Los requisitos son:\n1. uno{'o' * size}. Va;\n{'2' * min(size, 60)}. dos."
    assert len(sentences.sentences(items, model)) == 3


def test_the_model_is_bounded(spark):
    """Rare types of a large corpus are not learned: a class has at most 1 / RARE entries."""
    rows = [(i, "El Sr. Pérez y la Dra. Gómez firmaron. " * 5 + f"Un raro{chr(97 + i % 26)} va.", "es") for i in range(200)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    many = sentences.learn(d).count()
    before, sentences.RARE = sentences.RARE, 0.01
    try:
        few = sentences.learn(d)
        assert few.groupBy("clase").count().agg(F.max("count")).first()[0] <= 100 and few.count() < many
    finally:
        sentences.RARE = before


def test_an_address_does_not_bind_text_without_blanks(model):
    parts = ["第843包因无有效报价而废标。" * 1, "请联系" + "评审委员会" * 40 + "。", "邮箱a@celmi.invalid"]
    text = "".join(parts)
    assert [text[a:b] for a, b in sentences.sentences(text, model)] == parts


def test_stops_after_long_types_are_counted():
    import pyarrow as pa

    texts = ["Corto. Sigue", "x" * 41 + ". Sigue", "評" * 90 + ". 請", "(\"). Sigue", "y" * 40 + ". Sigue"]
    batch = pa.RecordBatch.from_arrays([pa.array(["es"] * 5), pa.array(texts)], names=["lang", "t"])
    rows = [r for b in sentences._count(iter([batch])) for r in b.to_pylist() if r["k"] == "p"]
    assert sum(r["n"] for r in rows) == 5
    assert {(r["a"], r["b"], r["c"], r["n"]) for r in rows if r["a"] == sentences.UNJUDGED} == {(sentences.UNJUDGED, "", "oth", 3)}


def test_structure(model):
    text = "1. Objeto de la contratación\n\nLos requisitos mínimos son:\ni. muestra de 2.5 kg. Se devuelve al cierre;\nii. copia del certificado.\n\nEl plazo es de 9\ndías. Fin\r\nde la línea."
    assert [text[a:b] for a, b in sentences.sentences(text, model)] == [
        "1. Objeto de la contratación", "Los requisitos mínimos son:", "i. muestra de 2.5 kg. Se devuelve al cierre;", "ii. copia del certificado.", "El plazo es de 9\ndías.", "Fin\r\nde la línea.",
    ]


def test_no_blank_and_lower_case(model):
    text = "Se declara desierto.El comité respondió. no se aceptarán ofertas"
    assert [text[a:b] for a, b in sentences.sentences(text, model)] == ["Se declara desierto.", "El comité respondió.", "no se aceptarán ofertas"]


def test_every_character_is_covered(spark, data, model):
    for r in table(spark, data, "documents").select("text").collect():
        text, last = r["text"] or "", 0
        for a, b in sentences.sentences(r["text"], model):
            assert a >= last and not text[last:a].strip() and text[a:b] == text[a:b].strip() != ""
            last = b
        assert not text[last:].strip()


def test_odd_inputs(spark):
    rows = [(1, None, None), (2, "", "es"), (3, " \n ", "es"), (4, "«", "xx"), (5, "...", None), (6, "a." * 20_000, "es"), (7, "x" * 100_000, "es"), (1, "Uno. Dos", "es")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("inicio", F.lit("clash"))
    got = sentences.split_sentences(d)
    assert got.columns == ["doc_id", "inicio", "fin"]
    found = {r["doc_id"] for r in got.collect()}
    assert {4, 5, 6, 7, 1} <= found and not found & {2, 3}
    assert sentences.split_sentences(d.limit(0)).count() == 0
