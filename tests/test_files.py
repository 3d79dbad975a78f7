"""Sources, sinks and the incremental intake on small files."""

from __future__ import annotations

import json

from inkweave.sources import files
from inkweave.streaming import incremental


def test_records_round_trip(spark, tmp_path):
    rows = [("v", "a", 1, 2, 3, "chữ", None, 4, 0.5, ["x"])]
    df = spark.createDataFrame(rows, files.SCHEMAS["vi_sentences"])
    assert files.write_records(df, str(tmp_path / "out")) == 1
    back = files.records(spark, str(tmp_path / "out"), "vi_sentences").first()
    assert (back.id, back.text, back.raw_text, back.box_ids) == ("a", "chữ", None, ["x"])
    assert files.records(spark, str(tmp_path / "none"), "vi_sentences", optional=True).count() == 0


def test_dictionaries_and_rules(spark, tmp_path):
    p = tmp_path / "s.dic"
    p.write_text("# c\n百:B C\n\nno colon\n百: D  E\nTrăm:百\n")
    got = {r.key: r["values"] for r in files.dictionary(spark, str(p), lower_keys=True).collect()}
    assert got == {"百": ["D", "E"], "trăm": ["百"]}
    files.write_dictionary(files.dictionary(spark, str(p)), str(tmp_path / "dic"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "dic")).collect()) == ["Trăm:百", "百:D E"]
    r = tmp_path / "rules.csv"
    r.write_text("wrong,correct\n# note\na,b\na,c\nlone\n")
    assert [tuple(x) for x in files.rule_table(spark, str(r), ["wrong", "correct"]).collect()] == [("a", "c")]
    assert [tuple(x) for x in files.rule_table(spark, str(r), ["wrong", "correct"], last_wins=False).collect()] == [("a", "b")]
    v = tmp_path / "voc.txt"
    v.write_text(" An \nan\n\n")
    assert [x.token for x in files.vocabulary(spark, str(v)).collect()] == ["an"]
    assert files.vocabulary(spark, str(tmp_path / "missing.txt")).count() == 0


def test_unihan_and_kanji(spark, tmp_path):
    u = tmp_path / "u.txt"
    u.write_text("# x\nU+767E\tkVietnamese\tbách hoà bách\nU+767E\tkOther\tno\nU+767E\tkZVariant\tU+4F70<kA U+767E\n")
    r = files.unihan_readings(spark, str(u)).first()
    assert (r.char, r.readings) == ("百", ["bách", "hòa"])
    assert [tuple(x) for x in files.unihan_variants(spark, str(u), ["kZVariant"]).collect()] == [("百", ["佰"])]
    k = tmp_path / "k.json"
    k.write_text(json.dumps([["百", "", "bách bá bách"], ["百", "x"], ["千", "thiên"], ["天", ""], ["天", "THIÊN hoà"], ["地", None, None]]))
    assert {x.char: x.readings for x in files.kanji_readings(spark, str(k)).collect()} == {"百": ["bách", "bá"], "千": ["thiên"], "天": ["thiên", "hòa"]}


def test_reading_tables_and_phrase_rules(spark, tmp_path):
    h = tmp_path / "h.csv"
    h.write_text("char,hanviet,pinyin\n百,\"['Bách', 'bá']\",x\n佰,['bách'],y\n千,,z\n")
    assert {r.key: r["values"] for r in files.listed_readings(spark, str(h)).collect()} == {"bách": ["佰", "百"], "bá": ["百"]}
    assert files.reading_table(spark, str(tmp_path / "none.csv")).count() == 0
    p = tmp_path / "p.csv"
    p.write_text("# rules\nwrong,correct,note\nb b,B,x\n a ,A\nalone\n\n")
    assert files.phrase_rules(spark, str(p)) == [("b b", "B"), ("a", "A")] and files.phrase_rules(spark, str(tmp_path / "none")) == []


def test_images(spark, tmp_path):
    (tmp_path / "page_012.gray").write_bytes(bytes([0, 255, 100, 200]))
    r = files.page_images(spark, str(tmp_path / "*.gray"))
    assert r.select("page", files.ink_share(r.content).alias("ink")).first()[:] == (12, 0.5)


def test_incremental_intake(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    row = lambda i, t: json.dumps({"vol": "v", "id": i, "text": "chữ", "loaded_at": t})
    (folder / "1.json").write_text(row("a", "2024-01-01T00:00:00") + "\n" + row("a", "2024-01-02T00:00:00") + "\n" + row("b", "2024-01-01T00:00:00"))
    for extra in (None, row("a", "2024-01-03T00:00:00") + "\n" + row("c", "2024-01-03T00:00:00")):
        if extra:
            (folder / "2.json").write_text(extra)
        s = incremental.once_within(incremental.arriving(spark, str(folder), "vi_sentences"))
        incremental.append_once(s, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b", "c"]
