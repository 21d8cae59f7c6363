"""A small project run from files to files, with outputs worked out by hand."""

import csv
import dataclasses
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from mapweave.plans.job import FixedColumns, JobFiles, MappedRecords, read_inputs, run_job
from mapweave.plans.rules import read_rules
from mapweave.sources import writers
from mapweave.sources.publish import published
from mapweave.sources.storage import Staging


def record(rid, **values):
    base = {
        "proposal_id": str(rid),
        "redcap_repeat_instrument": "",
        "redcap_repeat_instance": "",
        "proposal_title2": "A pilot study",
        "pi_firstname": " MARY ",
        "pi_lastname": "Smith",
        "contact": "Mary Smith, PhD",
        "start": "2020-1-2",
        "budget": "1.5",
        "funded": "yes",
        "org": "",
        "org_other": "",
        "area___1": "0",
        "area___2": "",
        "reviewer_name_north": "",
        "reviewer_name_south": None,
        "leftover": "x",
    }
    return base | values


RECORDS = [
    record(1, area___1="1", area___2="1", org="3", reviewer_name_north="Ann"),
    record(2, area___2="1", org_other="4", contact="Dr. J. Lee", reviewer_name_south="Ann"),
    # Same applicant as record 1, nothing ticked.
    record(3, org="3", start="01/02/2020", budget="", funded="maybe"),
    # A repeat, an unlisted record and two blocked ones.
    record(4, redcap_repeat_instance="1", area___1="1", reviewer_name_north="Eve"),
    record(5, area___1="1"),
    record(6, org="9", contact=None),
    record(7, org="9", contact="Sue Ray"),
    # Blocked only if its contact were null.
    record(8, org="7", contact="unknown", area___1="1", reviewer_name_north="Ann"),
    record(9, org="7", proposal_title2="Untitled", area___1="1"),
]


def rule(table, column, kind, args=(), type="text", primary="no", initialize="yes", **more):
    return {
        "table": table, "column": column, "kind": kind, "args": list(args), "type": type,
        "primary": primary, "initialize": initialize, **more,
    }


RULES = [
    rule("proposal", "ProposalID", "field", ["proposal_id"], "int", "yes"),
    rule("proposal", "applicant", "generate_id", ["pi_firstname", "pi_lastname", "contact"], "int"),
    rule("proposal", "start", "field", ["start"], "date"),
    rule("proposal", "budget", "field", ["budget"], "int"),
    rule("proposal", "funded", "field", ["funded"], "boolean"),
    rule("proposal", "org", "first_nonblank", ["org", "org_other"]),
    rule("proposal", "region", "field", ["region"]),
    rule("applicant", "applicant", "generate_id", ["pi_firstname", "pi_lastname", "contact"], "int", "yes"),
    rule("applicant", "first", "first_name", ["contact"]),
    rule("applicant", "last", "last_name", ["contact"]),
    rule("applicant", "kind", "if_equal", ["contact", '"unknown"', '"none"', '"person"']),
    rule("applicant", "later", "none", type=None),
    rule("area", "ProposalID", "field", ["proposal_id"], "int", True),
    rule("area", "area", "field", ["area"], primary="yes"),
    rule("area", "upper_title", "expr", ["upper(proposal_title2)"], sources=["proposal_title2"]),
    rule("gone", "gone", "field", ["no_such_column"]),
    rule(None, "loose", "field", ["org"]),
    rule("proposal", "skipped", "field", ["leftover"], initialize="no"),
    rule("proposal", "fixed", "literal", ['"x"']),
]
for ordinal, entry in enumerate(RULES):
    entry["ordinal"] = ordinal

DICTIONARY = [
    {"field_name": "area", "field_label": "Area", "select_choices_or_calculations": "1, Heart | 2, Lung"},
    {"field_name": "org", "field_label": "Org", "select_choices_or_calculations": "3, Three| 4, Four"},
    {"field_name": "leftover", "field_label": "", "select_choices_or_calculations": "1, a"},
    {"field_name": "contact", "field_label": "Contact", "select_choices_or_calculations": ""},
    {"field_name": "budget", "field_label": "Budget", "select_choices_or_calculations": "[a] + [b]"},
    {"field_name": "ctsa_12", "field_label": "University, North", "select_choices_or_calculations": None},
]


@pytest.fixture
def files(tmp_path):
    for name, content in (("records", RECORDS), ("rules", RULES), ("dictionary", DICTIONARY)):
        (tmp_path / f"{name}.json").write_text(json.dumps(content, indent=1))
    lists = {
        "enrich/a.csv": "proposal_id,site\n1,s1\n2,s2\n8,s1\n",
        "enrich/b.csv": "site,region\ns1,east\n",
        "restrict/listed.csv": "proposal_id\n1\n2\n3\n6\n7\n8\n9\n",
        "block/one.csv": "org,contact\n9,\n9,Sue Ray\n7,\n",
    }
    for name, text in lists.items():
        path = tmp_path / "lists" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    folder = str(tmp_path)
    return JobFiles(
        records=f"{folder}/records.json",
        rules=f"{folder}/rules.json",
        dictionary=f"{folder}/dictionary.json",
        output=f"{folder}/out",
        enrich=f"{folder}/lists/enrich",
        restrict=f"{folder}/lists/restrict",
        block=f"{folder}/lists/block",
    )


def read_back(directory):
    """Header and sorted rows of a table written as part files."""
    header, out = None, []
    for part in sorted(directory.glob("part-*")):
        with part.open(newline="") as stream:
            lines = list(csv.reader(stream))
        if lines:
            header, out = lines[0], out + lines[1:]
    return header, sorted(out)


def test_job_from_files_to_files(spark, files, tmp_path):
    files = dataclasses.replace(files, rejects=True)
    counts = run_job(spark, files, count_rows=True)
    assert counts == {"proposal": 5, "applicant": 3, "area": 5, "reviewer_organization": 2, "name": 7}
    out = Path(published(spark, files.output))
    tables = out / "tables"

    header, applicants = read_back(tables / "applicant")
    assert header == ["applicant", "first", "last", "kind"]
    ids = {(first, last): i for i, first, last, _ in applicants}
    assert sorted(ids.values()) == ["0", "1", "2"]
    mary, lee, unknown = ids["Mary", "Smith"], ids["J.", "Lee"], ids["unknown", "unknown"]
    assert {a[3] for a in applicants if a[0] == unknown} == {"none"}

    header, proposals = read_back(tables / "proposal")
    assert header == ["ProposalID", "applicant", "start", "budget", "funded", "org", "region"]
    assert proposals == [
        ["1", mary, "2020-01-02", "1", "true", "3", "east"],
        ["2", lee, "2020-01-02", "1", "true", "4", ""],
        ["3", mary, "", "", "", "3", ""],
        ["8", unknown, "2020-01-02", "1", "true", "7", "east"],
        ["9", mary, "2020-01-02", "1", "true", "7", ""],
    ]

    header, areas = read_back(tables / "area")
    assert header == ["ProposalID", "area", "upper_title"]
    assert areas == [
        ["1", "area___1", "A PILOT STUDY"],
        ["1", "area___2", "A PILOT STUDY"],
        ["2", "area___2", "A PILOT STUDY"],
        ["8", "area___1", "A PILOT STUDY"],
        ["9", "area___1", "UNTITLED"],
    ]

    assert read_back(tables / "reviewer_organization") == (
        ["reviewer", "organization"],
        [["Ann", "north"], ["Ann", "south"]],
    )

    header, labels = read_back(tables / "name")
    assert header == ["table", "column", "index", "description", "id"]
    assert labels == sorted([
        ["", "loose", "3", "Three", "org___3"],
        ["", "loose", "4", "Four", "org___4"],
        ["Submitter", "submitterInstitution", "12", "University, North", "org_name___12"],
        ["area", "area", "1", "Heart", "area___1"],
        ["area", "area", "2", "Lung", "area___2"],
        ["proposal", "org", "3", "Three", "org___3"],
        ["proposal", "org", "4", "Four", "org___4"],
    ])
    # Every ticked value is decoded by the dimension.
    assert {a[1] for a in areas} <= {row[4] for row in labels}

    def report(name):
        return sorted(
            line for p in (out / name).glob("part-*") for line in p.read_text().split()
        )

    # site came with a list, applicant was generated; a field used by several
    # expressions is missing once for each use but one.
    assert report("unknown") == [
        "applicant", "leftover", "redcap_repeat_instance", "redcap_repeat_instrument",
        "reviewer_name_north", "reviewer_name_south", "site",
    ]
    assert report("missing") == ["contact", "contact", "contact", "no_such_column", "org"]

    header, restricted = read_back(out / "rejects" / "restrict")
    assert "site" in header and {r[header.index("proposal_id")] for r in restricted} == {"5"}
    assert sorted(p.name for p in (out / "rejects").iterdir()) == ["block", "primary", "restrict"]


def test_a_broken_run_leaves_the_outputs_of_the_one_before(spark, files, monkeypatch):
    run_job(spark, files)
    before = published(spark, files.output)
    seen = {p: p.read_bytes() for p in Path(before).rglob("*") if p.is_file()}
    write, names = writers.write_csv, ["unknown", "missing", "proposal", "applicant", "area", "reviewer_organization", "name"]
    for last in (3, len(names) - 1):
        written = []

        def write_some(df, path, header=True):
            if len(written) == last:
                raise OSError("the run ends here")
            write(df, path, header)
            written.append(path)

        monkeypatch.setattr(writers, "write_csv", write_some)
        with pytest.raises(OSError, match="ends here"):
            run_job(spark, files)
        assert published(spark, files.output) == before
        assert {p: p.read_bytes() for p in Path(before).rglob("*") if p.is_file()} == seen
        assert [p.name for p in Path(files.output, "runs").iterdir()] == [Path(before).name]
    monkeypatch.setattr(writers, "write_csv", write)
    run_job(spark, files)
    assert published(spark, files.output) != before


def test_stages_run_once_with_staging(spark, files):
    inputs = read_inputs(spark, files)
    inputs.drop_test_records = True
    plain, staged = MappedRecords(inputs), MappedRecords(inputs, Staging(spark))
    assert rows(plain.records) == rows(staged.records)
    assert plain.rejects.keys() == staged.rejects.keys() == {"primary", "restrict", "block", "test"}
    for name, df in plain.rejects.items():
        assert df.columns == staged.rejects[name].columns
        assert rows(df) == rows(staged.rejects[name])
        assert "Join" not in staged.rejects[name]._jdf.queryExecution().executedPlan().toString()
    counts = staged.stage_rows
    assert counts["test"] == staged.records.count()
    assert counts["restrict"] - counts["block"] == staged.rejects["block"].count() > 0


def test_ids_stay_over_several_runs(spark, files, tmp_path):
    files = dataclasses.replace(files, key_registry=str(tmp_path / "ids"), restrict="")

    def ids():
        _, found = read_back(Path(published(spark, files.output)) / "tables" / "applicant")
        return {(first, last): int(i) for i, first, last, _ in found}

    run_job(spark, files)
    first = ids()
    more = [{**RECORDS[0], "proposal_id": str(100 + i), "contact": f"{name} Newname"} for i, name in enumerate(["Ada", "Bea", "Cleo", "Dora"])]
    Path(files.records).write_text(json.dumps(RECORDS[1:] + more))
    run_job(spark, files)
    second = ids()
    assert all(second[k] == v for k, v in first.items() if k in second)
    Path(files.records).write_text(json.dumps(RECORDS + more))
    run_job(spark, files)
    third = ids()
    assert third == first | second
    assert sorted(third.values()) == list(range(len(third)))


def test_test_records_can_be_dropped(spark, files):
    inputs = read_inputs(spark, files)
    inputs.drop_test_records = True
    mapped = MappedRecords(inputs)
    assert rows(mapped.mapped_tables["proposal"].select("ProposalID")) == [(1,), (2,), (3,), (8,)]
    assert rows(mapped.rejects["test"].select("proposal_id")) == [(9,)]


def test_without_lists_and_dictionary(spark, files):
    inputs = read_inputs(spark, files)
    inputs.enrich, inputs.restrict, inputs.block, inputs.dictionary = [], [], [], None
    inputs.rules = [r for r in inputs.rules if r.column != "region"]
    mapped = MappedRecords(inputs)
    assert sorted(mapped.tables()) == ["applicant", "area", "proposal", "reviewer_organization"]
    assert mapped.mapped_tables["proposal"].count() == 8


def test_rules_come_in_ordinal_order(spark, files):
    rules = read_rules(spark, files.rules)
    assert len(rules) == len(RULES) - 1
    assert [r.column for r in rules[:3]] == ["ProposalID", "applicant", "start"]
    assert [r.primary for r in rules[:2]] == [True, False]
    assert [r.primary for r in rules if r.table == "area"] == [True, True, False]
    assert rules[14].reads == ("proposal_title2",)


def test_other_column_names(spark, files, caplog):
    inputs = read_inputs(spark, files)
    names = {
        "redcap_repeat_instrument": "instrument", "redcap_repeat_instance": "instance",
        "reviewer_name_north": "judge_north", "reviewer_name_south": "judge_south",
    }
    inputs.records = inputs.records.withColumnsRenamed(names)
    inputs.dictionary = inputs.dictionary.withColumn(
        "field_name", F.regexp_replace("field_name", "^ctsa_", "site_")
    )
    inputs.columns = FixedColumns(
        repeat_instrument="instrument", repeat_instance="instance", reviewer_prefix="judge_",
        members={"pattern": "^site_[0-9]*$", "index_start": 6}, ignored=("leftover", "site"),
    )
    with caplog.at_level("WARNING"):
        mapped = MappedRecords(inputs)
    assert "reaches no table" in caplog.text
    assert mapped.mapped_tables["proposal"].count() == 5
    assert rows(mapped.reviewers) == [("Ann", "north"), ("Ann", "south")]
    assert mapped.labels.where("table = 'Submitter'").count() == 1
    assert [r[0] for r in rows(mapped.unknown)] == ["applicant", "instance", "instrument", "judge_north", "judge_south"]
