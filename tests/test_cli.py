"""The commands, by the files that they leave."""

from __future__ import annotations

import json

import pytest

from caseloom.plans import cli

OBO = """format-version: 1.2

[Term]
id: HP:0000001
name: All

[Term]
id: HP:0000002
name: Ataxia
synonym: "Unsteady gait" EXACT []
is_a: HP:0000001 ! All

[Term]
id: HP:0000003
name: Fever
is_a: HP:0000001 ! All
"""


@pytest.fixture
def obo(tmp_path):
    (tmp_path / "hp.obo").write_text(OBO)
    return str(tmp_path / "hp.obo")


def test_generate(spark, tmp_path, capsys):
    rows = ["ID , parsed_hpo_ids,parsed_omim_ids,parsed_pheno_text,parsed_variants,reference", "1,HP:0000002;HP:0000003,OMIM:123456,Ataxia;Fever,NM_1:c.1A>G,https://x.org/123", "2,HP:0000002,,,,", "3,,,,,"]
    (tmp_path / "parsed.csv").write_text("\n".join(rows) + "\n")
    assert cli.main(["generate", str(tmp_path / "parsed.csv"), "--output_dir", str(tmp_path / "out")]) == 0
    found = {p.name: json.loads(p.read_text()) for p in (tmp_path / "out").iterdir() if p.name.endswith(".json") and not p.name.startswith(".")}
    assert sorted(found) == ["CASE_1.json", "CASE_2.json", "CASE_3.json"]
    assert [f["type"]["label"] for f in found["CASE_1.json"]["phenotypicFeatures"]] == ["Ataxia", "Fever"] and found["CASE_1.json"]["diseases"][0]["term"]["id"] == "OMIM:123456"
    said = capsys.readouterr().out
    assert "Cases: 3" in said and "Documents: 3" in said and "Cases with variants: 1" in said and "1.50" in said and "  HP:0000002: 2" in said


def test_documents_that_fail_are_left_out(spark):
    parsed = spark.createDataFrame([("1", "HP:1", None, None, None, None), (None, "HP:1", None, None, None, None)], "ID string, parsed_hpo_ids string, parsed_omim_ids string, parsed_pheno_text string, parsed_variants string, reference string")
    good, bad = cli.pipelines.generate(parsed, "t")
    assert [r.id for r in good.collect()] == ["CASE_1"]
    (r,) = bad.collect()
    assert "'id' is missing" in r.messages


def test_convert_annotate_validate_and_rank(spark, tmp_path, obo, capsys):
    head = "ID\tsex\tage\tphenotypicFeatureIds\tgenomicVariants\tvariantInterpretation\tdiagnosticComment\tdataSourceType\texternalReference\tconsanguinityStatus\tfamilyId\ttotalFamilyMembers\ttotalCohortMembers\tprocedure\tprocedureStrategy\tzygosityStatus"
    rows = [f"C{i}\tM\t3Y\tHP:000000{2 + i % 2}\t{'AB'[i % 2]}1:c.1A>G\tVUS\tX (OMIM:123456)\tlit\tPMID:1\t\t\t\t\t\t\t" for i in range(6)]
    (tmp_path / "cases.tsv").write_text("\n".join([head, *rows]) + "\n")
    out = tmp_path / "packets.json"
    assert cli.main(["convert", "-i", str(tmp_path / "cases.tsv"), "-o", str(out), "--hpo", obo]) == 0
    made = json.loads(out.read_text())
    assert [d["id"] for d in made] == [f"C{i}" for i in range(6)] and out.read_text().startswith('[\n  {\n    "id"')
    said = capsys.readouterr().out
    assert "Documents: 6" in said and "With sex: 6 (100.0%)" in said and "First feature: HP:0000002, Ataxia" in said and "First variant: A1:c.1A>G, gene A1" in said
    assert cli.main(["validate", str(out)]) == 0
    (tmp_path / "bad.json").write_text('[{"id":"a"}]')
    assert cli.main(["validate", str(tmp_path / "bad.json")]) == 1
    assert cli.main(["convert", "-i", str(tmp_path / "cases.tsv"), "-o", str(out), "-f", "individual", "--hpo", obo]) == 0
    each = tmp_path / "packets_individual"
    assert sorted(p.name for p in each.iterdir() if p.name.endswith(".json") and not p.name.startswith(".")) == [f"C{i}.json" for i in range(6)]
    (tmp_path / "genes.tsv").write_text("gene\tterm\nA1\tHP:0000002\nB1\tHP:0000003\n")
    args = ["rank", "--packet_dir", str(each), "--associations", str(tmp_path / "genes.tsv"), "--hpo", obo, "--output_json", str(tmp_path / "ranks.json"), "-q", "--log-file", str(tmp_path / "log")]
    assert cli.main(args) == 0
    ranks = json.loads((tmp_path / "ranks.json").read_text())
    assert [r["rank"] for r in ranks] == [1] * 6 and '\n        "packet_id"' in (tmp_path / "ranks.json").read_text()
    assert (tmp_path / "log").read_text() == ""
    (tmp_path / "texts.tsv").write_text("id\ttext\np1\tunsteady gait but no fever\np2\tqqq\n")
    assert cli.main(["annotate", "-i", str(tmp_path / "texts.tsv"), "-o", str(tmp_path / "terms.json"), "--hpo", obo]) == 0
    assert json.loads((tmp_path / "terms.json").read_text()) == {"p1": ["HP:0000002"], "p2": []}
