"""Tables of the shapes met in practice, with made-up values."""

from cardfile.operators import columns, dedup, matching
from cardfile.operators.links import dedup_links
from cardfile.plans import jobs
from cardfile.sources import tables as t


def write(path, lines):
    path.write_text("\n".join(lines), encoding="utf-8")
    return str(path)


def test_quoted_leads(spark, tmp_path):
    head = '"Business_Name","Name","Phone","Address","Website","URL","Emails"'
    rows = [
        f'"Fine Homes, Inc. {i % 3}","Ann  Lee {i}","(305) 555-{i:04d}","{i} Main St, Town","","https://x.com/{i}","A{i}@X.com"'
        for i in range(9)
    ]
    rows.append('"Fine Homes, Inc. 1","Zoë","305 555 0001 / 305 555 0002","","","https://x.com/9","a1@x.com; z@x.com"')
    df = t.read_contacts(spark, write(tmp_path / "leads.csv", [head, *rows]))
    assert df.count() == 10 and df.columns[-1] == "Emails"
    assert dedup.dedup_phone(df, columns.find_first(df, "phone"), "URL").count() == 10
    unique, rest = dedup.dedup_text(df, "Business_Name", "URL")
    assert (unique.count(), rest.count()) == (3, 7)
    # the address of row 1 is also in the last row
    kept = jobs.unique_email_rows(df, "URL")
    assert sorted(r.URL[-1] for r in kept.collect()) == list("02345678")
    statuses = t.read_contacts(
        spark, write(tmp_path / "s.csv", ["Email address,Validation Status", "a1@x.com ,Deliverable", "Z@x.com,Deliverable"])
    )
    got = jobs.match_deliverable(df, statuses, "URL").collect()
    assert sorted((r.URL[-1], r.Emails) for r in got) == [("1", "a1@x.com"), ("9", "a1@x.com")]


def test_column_names_with_signs(spark, tmp_path):
    path = write(tmp_path / "a.csv", ['"URL","rounded-[16px] src","text-[#181D27]","agent.pos"', "u1,s,Ann  Lee,x", "u2,s, ann lee,y"])
    df = t.read_contacts(spark, path)
    name = columns.find_first(df, "[#")
    assert dedup.dedup_text(df, name, "URL")[0].count() == 1
    pos = columns.find_first(df, "POS")
    known = df.filter(columns.quoted(pos) == "y").select(columns.quoted(pos))
    assert [r[0] for r in matching.resume(df, known, pos).collect()] == ["u1"]
    flagged = matching.flag_exact(df, pos, known).select("URL", "Matched").collect()
    assert {tuple(r) for r in flagged} == {("u1", False), ("u2", True)}
    changed = columns.replace_col(df, pos, columns.quoted(name))
    assert changed.columns == df.columns


def test_resume_against_an_empty_output(spark, tmp_path):
    done = t.read_contacts(spark, write(tmp_path / "d.csv", ["Business_Name,Name,URL", ""]))
    todo = spark.createDataFrame([("u",), ("u",), ("v",)], "URL string")
    assert matching.resume(todo, done, "URL").count() == 3
    assert matching.resume(todo, done, "URL", distinct=True).count() == 2


def test_sites_under_another_header(spark, tmp_path):
    sites = t.read_contacts(spark, write(tmp_path / "o.csv", ["agent_url", "https://x.com/a", "https://x.com/b"]))
    good, bad = jobs.usable_sites(sites)
    assert good.count() == 0 and bad.count() == 0


def test_links_under_two_offices(spark):
    rows = [(o, p, f"https://x.com/{i}") for o in (1, 2) for p, i in enumerate(range(o * 2, 16))]
    df = spark.createDataFrame(rows, "office int, place int, agent_url string")
    got = dedup_links(df, "agent_url", "office", "place").collect()
    assert len(got) == 14 and {r.office for r in got} == {1}


def test_names_with_line_breaks(spark, tmp_path):
    path = write(tmp_path / "p.csv", ["Business_Name,Name,URL", '"ANN\nLEE","ANN\nLEE",u1', ",,u2"])
    df = jobs.fix_business_names(t.read_contacts(spark, path))
    # "Business_Name" is the last column naming a business, "Name" the last naming a person
    assert sorted(tuple(r) for r in df.collect()) == [("", "", "u2"), ("ANN\nLEE", "ANN\nLEE", "u1")]
