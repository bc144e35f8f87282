import pytest
from fundloom.llm import mojibake as M

TEXTS = [
    "À la date d’arrêté, la société de gestion a enregistré une plus-value de €5.2 M.", "Die Geschäftsführung hat Ausschüttungen größer gemeldet – «geprüft».",
    "Na dzień wyceny spółka zakończyła sprzedaż udziałów, głównie w branży żywność.", "Согласно договору инвестиционный комитет завершил продажу доли.",
    "A participação não alterou a provisão; comissões em exposição.",
]
CLEAN = [
    "Δ NAV ≤ 5%, σ ≈ 12%.", "Cost basis √t·σ, π = 3.14.", "Reference: ’Š’ series, ‚Ž‘ series.", "│ Class A │ 40% │", "ÎLE NORD, ÊTRE ASSOCIÉ, À VALOIR.", "¹ Net of fees.",
    "Ðelta and Þorn series, «closed».", "Łódka project, Čelo project, Řeka project.", "Charge of 2¢ per unit • all classes.", "Column › “Âge moyen” ‹ see annex…",
    "Ñandú ºclass. ªclass, (½ m²) ±2.5%, §4(b).", "", "plain", *TEXTS,
]


def garble(text, read):
    return "".join(bytes([b]).decode(read) if _defined(b, read) else chr(b) for b in text.encode("utf-8"))


def _defined(b, read):
    try:
        bytes([b]).decode(read)
    except UnicodeDecodeError:
        return False
    return True


@pytest.mark.parametrize("text", CLEAN)
def test_clean_text_is_left_alone(text):
    assert M.repair(text) == (text, 0, False)


@pytest.mark.parametrize("text", TEXTS[:3] + TEXTS[4:])
@pytest.mark.parametrize("read", ["cp1252", "latin-1", "mac_roman", "cp437"])
@pytest.mark.parametrize("layers", [1, 2])
def test_round_trip(text, read, layers):
    bad = text
    for _ in range(layers):
        bad = garble(bad, read)
    fixed, stretches, lost = M.repair(bad)
    assert stretches and not lost and fixed == text


WORLD = [
    "株式会社の四半期報告書をご確認ください。", "הדוח הרבעוני של הקרן מצורף.", "التقرير الفصلي للصندوق مرفق.", "รายงานรายไตรมาสของกองทุน", "Report ready 😀 thanks", "基金季度报告", "펀드 분기 보고서",
    "फंड की तिमाही रिपोर्ट", "Έκθεση του ταμείου",
]


@pytest.mark.parametrize("text", WORLD)
def test_clean_text_of_any_script_is_left_alone(text):
    assert M.repair(text) == (text, 0, False)
    assert M.repair(text + " " + TEXTS[0]) == (text + " " + TEXTS[0], 0, False)


@pytest.mark.parametrize("text", WORLD)
@pytest.mark.parametrize("read", ["cp1252", "latin-1", "mac_roman"])
def test_any_script_comes_back(text, read):
    assert M.repair(garble(text, read))[0] == text
    assert M.repair("Net asset value. " + garble(text, read))[0] == "Net asset value. " + text


def test_latin_letters_of_another_language():
    spanish = "La inversión del señor Núñez terminó en marzo."
    assert M.repair(spanish.encode("cp1252").decode("mac_roman"))[0] == spanish
    french = "La mère célèbre la fête à Nîmes."
    assert M.repair(french.encode("cp1252").decode("cp1250"))[0] == french
    for clean in (spanish, french, "Łódź and Škoda met Müller in São Paulo.", "Žižkov, Kraków, Malmö", "İstanbul’da güçlü büyüme"):
        assert M.repair(clean) == (clean, 0, False)


def test_many_layers():
    bad = TEXTS[4]
    for _ in range(7):
        bad = garble(bad, "latin-1")
    assert M.repair(bad)[0] == TEXTS[4]


def test_partly_garbled_and_lost():
    half = TEXTS[0] + " " + garble(TEXTS[4], "cp1252")
    assert M.repair(half)[0] == TEXTS[0] + " " + TEXTS[4]
    assert M.repair("administrator�s statement")[1:] == (1, True)


@pytest.mark.parametrize(("read", "meant"), [("cp1251", "koi8_r"), ("cp1252", "cp1251"), ("latin-1", "cp866")])
def test_single_byte_swaps(read, meant):
    bad = TEXTS[3].encode(meant).decode(read)
    fixed, stretches, _ = M.repair(bad)
    assert stretches and sum(a == b for a, b in zip(fixed, TEXTS[3], strict=True)) > 0.9 * len(fixed)


def test_table(spark):
    rows = [(1, garble(TEXTS[0], "cp1252"), 7), (2, TEXTS[0], 7), (3, None, 7), (4, "", 7), (5, garble("é" * 30_000, "cp1252"), 7), (1, garble(TEXTS[0], "cp1252"), 7)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, stretches int")
    out = M.repaired(df)
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 1, 5]
    assert {r["repaired_text"] for r in out.filter("doc_id = 5").collect()} == {"é" * 30_000}
    assert M.repaired(df.limit(0)).count() == 0
