from docketlake.llm import license_scan


def test_short_templates(spark):
    rows = [(1, "Some prose. All rights reserved."), (2, "rights all reserved all rights, not reserved"), (3, "ALL RIGHTS\nRESERVED; released under the MIT License. All rights reserved"), (4, "all"), (5, None), (6, "proprietary goods")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["license"], r["containment"]) for r in license_scan.scan(docs).collect())
    assert got == [(1, "All-Rights-Reserved", 1000), (3, "All-Rights-Reserved", 1000), (3, "MIT", 1000)]
    assert {(r["doc_id"], r["start_word"]) for r in license_scan.scan(docs).where("license = 'All-Rights-Reserved'").collect()} == {(1, 2), (3, 0)}
    assert [(r["doc_id"], r["license"]) for r in license_scan.scan(docs, {"own": ["Proprietary"]}).collect()] == [(6, "own")]
