import json
import os
import subprocess
import sys
import tempfile

from conftest import SF001

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def lines(out):
    return [x for x in out.splitlines() if x.startswith("{")]


def run(*args):
    out = subprocess.run([sys.executable, "-m", "tidemark", "--master", "local[2]", *args], cwd=REPO,
                         capture_output=True, text=True, timeout=600)
    return out.returncode, out.stdout, out.stderr


def test_command_line_export_mirror_catalog_query():
    work = tempfile.mkdtemp(prefix="tidemark-cli-")
    q = f"{work}/queries"
    os.makedirs(f"{q}/feed")
    open(f"{q}/customers.sql", "w").write("SELECT c_custkey AS PK1, c_name FROM customer")
    open(f"{q}/bad_keys.sql", "w").write("SELECT l_orderkey AS PK1 FROM lineitem")
    open(f"{q}/feed/full.sql", "w").write("SELECT 0 AS __watermark, 'u' AS __op, 0 AS __deleted, * FROM lineitem")
    open(f"{q}/feed/delta.sql", "w").write(
        "SELECT CASE WHEN m.l_orderkey IS NULL THEN 2 ELSE 4 END AS __rowMarker__, d.o_orderkey AS l_orderkey "
        "FROM orders d LEFT JOIN lineitem m ON m.l_orderkey = d.o_orderkey WHERE d.o_orderkey > {WATERMARK}")
    open(f"{q}/feed/mirror.json", "w").write(json.dumps({"watermark_table": "orders",
                                                         "watermark_column": "o_orderkey"}))

    code, out, err = run("export", "--tables", SF001, "--queries", q, "--out", f"{work}/out")
    said = {x["statement"]: x for x in map(json.loads, lines(out))}
    assert code == 3 and said["customers"]["published"] > 0 and "repeats" in said["bad_keys"]["failure"]
    code, out, _ = run("export", "--tables", SF001, "--queries", q, "--out", f"{work}/out", "--query", "customers")
    assert code == 0 and [json.loads(x)["statement"] for x in lines(out)] == ["customers"]

    code, out, err = run("mirror", "--tables", SF001, "--queries", q, "--out", f"{work}/mirror")
    said = json.loads(lines(out)[0])
    assert code == 0 and (said["feed"], said["run"], said["sequence"]) == ("feed", "full", 1), err
    code, out, err = run("mirror", "--tables", SF001, "--queries", q, "--out", f"{work}/mirror")
    said = json.loads(lines(out)[0])
    assert code == 0 and (said["run"], said["sequence"], said["change_rows"]) == ("delta", 1, 0), err

    code, out, err = run("catalog", "--tables", SF001, "--out", f"{work}/catalog.json")
    assert code == 0 and json.loads(lines(out)[0])["tables"] == 14, err

    code, out, _ = run("query", "--tables", SF001, "--top", "3", "SELECT r_name FROM region ORDER BY r_name")
    assert code == 0 and [x.strip("| ") for x in out.splitlines() if x.startswith("|")] == ["r_name", "AFRICA", "AMERICA", "ASIA"]


def test_catalog_nested_and_query_file_in_process(spark, workdir, capsys):
    from tidemark.__main__ import main
    from tidemark.sources.catalog_doc import read_catalog
    assert main(["catalog", "--tables", SF001, "--out", f"{workdir}/nested", "--nested"]) == 0
    doc = read_catalog(spark, f"{workdir}/nested", nested=True).collect()
    assert len(doc) == 1 and len(doc[0].tables) == 14
    sql_file = tempfile.mkdtemp(prefix="tidemark-cli-") + "/q.sql"
    open(sql_file, "w").write("SELECT n_name FROM nation ORDER BY n_nationkey")
    assert main(["query", "--tables", SF001, "--file", sql_file, "--top", "2"]) == 0
    shown = [x.strip("| ") for x in capsys.readouterr().out.splitlines() if x.startswith("|")]
    assert shown == ["n_name", "NATION_0", "NATION_1"]
