"""File-level behaviour of the loaders on hand-made landing files."""

import csv
import os
import random

import pytest

from ledgerloom.operators import intermediate as I
from ledgerloom.operators import marts as M
from ledgerloom.operators import staging as S
from ledgerloom.plans.snapshots import Snapshots
from ledgerloom.sources import landing as L
from ledgerloom.sources.csv_records import parse_records, split_records
from ledgerloom.sources.ledger import Loader
from ledgerloom.streaming.incremental import incremental_csv_load, read_target

HEADER = "a,b,c,d,e,f,g,h,i,j\n"   # any header: columns bind by position


def _write(root, rel, text):
    path = os.path.join(root, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return os.path.dirname(os.path.dirname(path))


def _accounts(spark, scratch, body, multiline=False):
    prefix = _write(scratch, "postgres/accounts/ingestion_date=2026-10-03/part-0.csv", HEADER + body)
    return L.load_csv(spark, prefix, "accounts", multiline)


def test_null_markers_quotes_newlines_and_partition_column(spark, scratch):
    body = ('A-1,"Acme, Inc",NULL,null,2026-01-02,,Starter,3,True,FALSE\n'
            'A-2,"Ac""me\nInc","",x,2026-01-03,Ads,Business,,t,1\n')
    rows = {r.account_id: r for r in _accounts(spark, scratch, body, multiline=True).collect()}
    a1, a2 = rows["A-1"], rows["A-2"]
    assert a1.account_name == "Acme, Inc"
    assert a1.industry is None and a1.country is None and a1.referral_source is None
    assert a1.is_trial is True and a1.churn_flag is False
    assert a2.account_name == 'Ac"me\nInc'
    assert a2.industry is None and a2.seats is None
    assert a2.is_trial is True and a2.churn_flag is True
    df = _accounts(spark, scratch, body)
    assert "ingestion_date" not in df.columns
    assert [f.name for f in df.schema] == [f.name for f in L.CSV_TABLES["accounts"]]


def test_bad_boolean_aborts_the_load(spark, scratch):
    body = "A-1,n,i,c,2026-01-02,r,Starter,3,maybe,false\n"
    with pytest.raises(Exception):
        _accounts(spark, scratch, body).collect()


def test_short_row_aborts_the_load(spark, scratch):
    body = "A-1,n,i,c,2026-01-02,r,Starter,3,true\n"
    with pytest.raises(Exception):
        _accounts(spark, scratch, body).collect()


def test_too_long_value_aborts_the_load(spark, scratch):
    ok = f"{'A' * 50},n,i,c,2026-01-02,r,Starter,3,true,false\n"
    assert _accounts(spark, scratch, ok).count() == 1
    with pytest.raises(Exception, match="account_id longer than 50"):
        _accounts(spark, scratch, "A" + ok).collect()


def test_load_time_is_utc_in_any_session_zone(spark, scratch):
    import datetime as dt
    raw = _events(spark, scratch, ['{"event_id":"E1"}'])
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("Pacific/Auckland", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            at = L.load_json_variant(spark, os.path.join(scratch, "events/ai_usage")).first().ingested_at
            assert abs((at - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).total_seconds()) < 300
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert raw.count() == 1


def _events(spark, scratch, lines):
    prefix = _write(scratch, "events/ai_usage/year=2026/month=09/part-0.json", "\n".join(lines) + "\n")
    raw = L.load_json_variant(spark, os.path.dirname(prefix), ingested_at="2026-10-02 00:00:00")
    return raw


def test_json_casts_and_lineage(spark, scratch):
    lines = [
        '{"event_id":"E1","event_timestamp":"2026-09-03T10:11:12","input_tokens":"7","output_tokens":1.6,'
        '"latency_ms":10,"status":"success"}',
        '{"event_id":"E2","event_timestamp":"2026-09-03 10:11:12","input_tokens":null,"latency_ms":null,'
        '"status":" Success "}',
        '{"event_id":"E3","event_timestamp":"2026-09-03 10:11:12","input_tokens":0,"output_tokens":0,'
        '"latency_ms":10,"status":"weird"}',
        '{"event_id":"E4","event_timestamp":"2026-09-03 10:11:12","input_tokens":5,"latency_ms":null}',
        '{"event_id":"E5","input_tokens":-1.5}',
    ]
    raw = _events(spark, scratch, lines)
    stg = S.stg_ai_usage_events(raw)
    r = {x.event_id: x for x in stg.collect()}
    assert r["E1"].event_timestamp == r["E2"].event_timestamp
    assert r["E1"].input_tokens == 7 and r["E1"].output_tokens == 2 and r["E1"].total_tokens == 9
    assert r["E2"].input_tokens is None and r["E2"].output_tokens is None and r["E2"].total_tokens == 0
    assert r["E5"].input_tokens == -2
    assert r["E1"].source_file == "events/ai_usage/year=2026/month=09/part-0.json"
    assert str(r["E1"].ingested_at) == "2026-10-02 00:00:00"

    fact = {x.event_id: x for x in M.fact_ai_usage(stg).collect()}
    assert (fact["E1"].success_flag, fact["E1"].failure_flag) == (1, 0)
    assert (fact["E2"].success_flag, fact["E2"].failure_flag) == (0, 1)    # ' Success ' is not 'success'
    assert (fact["E3"].success_flag, fact["E3"].failure_flag) == (0, 1)
    assert (fact["E4"].success_flag, fact["E4"].failure_flag) == (0, 0)    # NULL status: neither

    met = {x.event_id: x for x in I.int_ai_usage_metrics(stg).collect()}
    assert (met["E2"].is_success, met["E2"].is_failure) == (1, 0)
    assert (met["E3"].is_success, met["E3"].is_failure) == (0, 0)          # 'WEIRD' is neither
    assert float(met["E3"].latency_per_token) == 0.0                      # no tokens → 0
    assert met["E4"].latency_per_token is None                            # no latency → NULL
    assert str(met["E1"].latency_per_token) == "1.111111"


def test_non_numeric_token_raises(spark, scratch):
    raw = _events(spark, scratch, ['{"event_id":"E1","input_tokens":"abc"}'])
    with pytest.raises(Exception):
        S.stg_ai_usage_events(raw).collect()


def test_alternative_preview_fields_are_null(spark, scratch):
    raw = _events(spark, scratch, ['{"event_id":"E1","model":"m","cost":"1.5"}'])
    r = S.preview_events_alt(raw).collect()[0]
    assert r.model_name is None and r.feature_name is None and r.tokens_used is None
    assert str(r.cost) == "1.500000"


def test_landing_roundtrip_keeps_values(spark, scratch):
    from tests.conftest import SF0001
    from ledgerloom.sources import driver_tables as DT
    src = DT.support_tickets(spark, SF0001)
    path = L.write_csv_landing(src, scratch, "support_tickets", "2026-10-02")
    back = L.load_csv(spark, path, "support_tickets")
    assert back.exceptAll(src).count() == 0 and src.exceptAll(back).count() == 0


def test_incremental_load_is_idempotent(spark, scratch):
    from tests.conftest import SF0001
    from ledgerloom.sources import driver_tables as DT
    src = DT.accounts(spark, SF0001)
    landing = os.path.join(scratch, "landing")
    path = L.write_csv_landing(src, landing, "accounts", "2026-10-02")
    target, ck = os.path.join(scratch, "t"), os.path.join(scratch, "ck")
    first = incremental_csv_load(spark, path, "accounts", target, ck)
    second = incremental_csv_load(spark, path, "accounts", target, ck)
    assert first == 160 and second == 0
    assert read_target(spark, target, "accounts").count() == 160
    # a new landing day is picked up, and only it
    L.write_csv_landing(src.limit(10), landing, "accounts", "2026-10-03")
    assert incremental_csv_load(spark, path, "accounts", target, ck) == 10
    assert read_target(spark, target, "accounts").count() == 170


def test_source_presence_gate(spark, scratch):
    from tests.conftest import SF0001
    from ledgerloom.sources import driver_tables as DT
    L.write_csv_landing(DT.accounts(spark, SF0001), scratch, "accounts", "2026-10-02")
    with pytest.raises(L.MissingSourceError, match="payments"):
        L.require_sources(spark, scratch)
    rows = {r.source: r.present for r in L.source_presence(spark, scratch).collect()}
    assert rows == {n: n == "accounts" for n in L.LANDING_PREFIX}


def test_gate_under_a_root_that_holds_a_prefix_name(spark, scratch):
    root = os.path.join(scratch, "external/payments/lake")
    for prefix in L.LANDING_PREFIX.values():
        _write(root, f"{prefix}/ingestion_date=2026-10-02/part-0.csv", "x\n")
    assert all(r["present"] for r in L.require_sources(spark, root))
    got = {(r.source, r.folder) for r in L.stage_folders(spark, root).collect()}
    assert got == {(n, f"{p}/ingestion_date=2026-10-02") for n, p in L.LANDING_PREFIX.items()}
    hidden = os.path.join(scratch, "other")
    _write(hidden, "postgres/accounts/_SUCCESS", "")
    assert not L.has_files(spark, os.path.join(hidden, "postgres/accounts"))


def test_incremental_counts_every_batch(spark, scratch):
    """More batches than a streaming query keeps progress of."""
    landing = os.path.join(scratch, "landing")
    for i in range(120):
        _write(landing, f"postgres/accounts/ingestion_date=2026-10-02/part-{i}.csv",
               HEADER + f"A-{i},n,i,c,2026-01-02,r,Starter,3,true,false\n")
    got = incremental_csv_load(spark, os.path.join(landing, "postgres/accounts"), "accounts", os.path.join(scratch, "t"),
                               os.path.join(scratch, "ck"), max_files_per_trigger=1)
    assert got == 120


def test_incremental_multiline(spark, scratch):
    _write(scratch, "postgres/accounts/ingestion_date=2026-10-02/part-0.csv",
           HEADER + 'A-1,"two\nlines",i,c,2026-01-02,r,Starter,3,true,false\n')
    t = os.path.join(scratch, "t")
    assert incremental_csv_load(spark, os.path.join(scratch, "postgres/accounts"), "accounts", t,
                                os.path.join(scratch, "ck"), multiline=True) == 1
    assert read_target(spark, t, "accounts").first().account_name == "two\nlines"


def test_missing_source_is_reported_and_skipped(spark, scratch, caplog):
    from tests.conftest import SF0001
    tables = os.path.join(scratch, "tables")
    os.makedirs(tables)
    for name in ("customer", "supplier", "nation", "region", "orders"):
        os.symlink(f"{SF0001}/{name}.parquet", f"{tables}/{name}.parquet")
    landed = L.write_landing(spark, tables, os.path.join(scratch, "landing"), "2026-10-02")
    assert landed["support_tickets"] is None and landed["ai_usage_events"] is None and landed["accounts"]
    assert "support_tickets skipped" in caplog.text
    with pytest.raises(L.MissingSourceError, match="ai_usage_events"):
        L.require_sources(spark, os.path.join(scratch, "landing"))


def test_files_of_an_unfinished_write_are_not_present(spark, scratch):
    _write(scratch, "postgres/accounts/_temporary/0/task/part-0.csv", "x\n")
    assert not L.has_files(spark, os.path.join(scratch, "postgres/accounts"))


def _line_break_files(scratch, eol, rows=300, lines=9000):
    """Three files with fields of one to thousands of lines, a header of two
    lines, and a last line without an end."""
    rng = random.Random(eol)
    names = ["plain", '"a, b"', f'"two{eol}lines"', '"q""q"', '""', f'"""x{eol}{eol}y"""', f'"""{eol}"""', '" sp "', "",
             '"' + f"z{eol}" * 20 + '"']
    for f in range(3):
        body = [f'A-{f}-{i},{rng.choice(names)},i,"c{eol}d",2026-01-02,r,Starter,3,true,false' for i in range(rows)]
        body[rows // 2] = f'A-{f}-long,"' + f"z{eol}" * lines + '",i,c,2026-01-02,r,Starter,3,true,false'
        head = f'a,"b{eol}b",c,d,e,f,g,h,i,j' if f == 1 else HEADER.strip()
        path = os.path.join(scratch, f"postgres/accounts/ingestion_date=2026-10-0{f + 1}/part-0.csv")
        os.makedirs(os.path.dirname(path))
        with open(path, "w", newline="") as out:
            out.write(eol.join([head, *body]) + (eol if f else ""))
    return os.path.join(scratch, "postgres/accounts")


@pytest.fixture()
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("eol", ["\n", "\r\n"])
def test_line_breaks_in_fields_are_read_by_many_tasks(spark, scratch, small_splits, eol):
    path = _line_break_files(scratch, eol)
    schema = L.string_schema(L.CSV_TABLES["accounts"])
    folder = os.path.join(scratch, "stored")
    records = split_records(spark, path, folder)
    got = sorted(tuple(r) for r in parse_records(records, schema).drop("_path").collect())
    want = []
    for f in range(3):
        with open(f"{path}/ingestion_date=2026-10-0{f + 1}/part-0.csv", newline="") as file:
            want += [tuple(v or None for v in r) for r in list(csv.reader(file))[1:]]
    key = lambda r: tuple(v or "" for v in r)       # noqa: E731
    assert sorted((tuple(v or None for v in r) for r in got), key=key) == sorted(want, key=key)
    assert spark.read.parquet(f"{folder}/blocks").groupBy("_path").count().agg({"count": "min"}).first()[0] > 5
    if eol == "\n":
        plain = spark.read.schema(schema).options(**L.csv_options(True)).csv(path).select(*schema.fieldNames())
        assert sorted(map(tuple, plain.collect()), key=key) == sorted(got, key=key)


def test_only_broken_lines_are_shuffled(spark, scratch, small_splits):
    """Without line breaks every line passes without a shuffle of texts."""
    body = "".join(f'A-{i},"n, n",i,c,2026-01-02,r,Starter,3,true,false\n' for i in range(2000))
    path = _write(scratch, "postgres/accounts/ingestion_date=2026-10-03/part-0.csv", HEADER + body)
    folder = os.path.join(scratch, "stored")
    assert split_records(spark, path, folder).count() == 2000
    blocks = spark.read.parquet(f"{folder}/blocks")
    assert blocks.count() > 5 and blocks.where("odd > 0 or before % 2 = 1").count() == 0
    assert L.load_csv(spark, path, "accounts", multiline=True).count() == 2000


def test_file_that_ends_inside_a_field_aborts(spark, scratch):
    ok = "A-1,n,i,c,2026-01-02,r,Starter,3,true,false\n"
    with pytest.raises(Exception, match="ends inside a quoted field"):
        _accounts(spark, scratch, ok + ok.replace("n,i", '"n,i'), multiline=True)


def test_blank_lines_and_files_without_records(spark, scratch):
    ok = "A-1,n,i,c,2026-01-02,r,Starter,3,true,false\n"
    assert _accounts(spark, scratch, "\n  \n" + ok + "\r\n" + ok, multiline=True).count() == 2
    _write(scratch, "postgres/accounts/ingestion_date=2026-10-04/part-0.csv", "")
    _write(scratch, "postgres/accounts/ingestion_date=2026-10-05/part-0.csv", HEADER)
    assert L.load_csv(spark, os.path.join(scratch, "postgres/accounts"), "accounts", multiline=True).count() == 2


def test_line_breaks_through_the_ledger(spark, scratch, small_splits):
    """A file touched without a change is no other file; new records are."""
    path = _line_break_files(scratch, "\r\n", rows=60, lines=80)
    snapshots = Snapshots(spark, os.path.join(scratch, "wh"))
    loader = Loader(spark, snapshots)
    loader.commit([loader.stage("accounts", scratch, multiline=True)])
    assert loader.rows("accounts").count() == 180
    file = f"{path}/ingestion_date=2026-10-01/part-0.csv"
    os.utime(file, (1, 1))
    assert Loader(spark, snapshots).stage("accounts", scratch, multiline=True).changed == []
    with open(file, "a", newline="") as f:
        f.write('\r\nA-x,"open,i,c,2026-01-02,r,Starter,3,true,false')
    assert Loader(spark, snapshots).stage("accounts", scratch, multiline=True).changed == [
        "postgres/accounts/ingestion_date=2026-10-01/part-0.csv"]
