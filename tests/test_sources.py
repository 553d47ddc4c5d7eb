import gzip
import os

import pytest

from staykit.sources.snapshots import list_files, parse_header, read_lookup_csv, read_snapshots
from staykit.schemas import LOCATION_SCHEMA


def local_dir(path):
    return path.replace("file:", "", 1) if path.startswith("file:") else path


def write(path, name, text, gz=False):
    os.makedirs(path, exist_ok=True)
    full = os.path.join(path, name)
    if gz:
        with gzip.open(full, "wt", encoding="utf-8") as f:
            f.write(text)
    else:
        with open(full, "w", encoding="utf-8") as f:
            f.write(text)


def test_drifting_headers_align_by_name(spark, scratch):
    root = local_dir(scratch("csv"))
    write(root, "2020-01-01.csv", "id,host_id,price,neighbourhood_cleansed,calendar_last_scraped\n"
                                  "1,10,\"$1,250.00\",Bondi,2020-01-01\n")
    # shuffled columns, an extra retired column with a quoted multi-line value, and an absent column
    write(root, "2020-02-01.csv", "summary,neighbourhood_cleansed,price,host_id,id\n"
                                  "\"two\nlines \"\"quoted\"\"\",Manly,150,11,2\n")
    write(root, "2020-03-01.csv.gz", "host_id,id,price,neighbourhood_cleansed\n12,3,N/A,\n", gz=True)
    df = read_snapshots(spark, root)
    got = {r.id: r for r in df.collect()}
    assert set(got) == {1, 2, 3}
    assert (got[1].host_id, got[1].price, got[1].neighbourhood_cleansed) == (10, "$1,250.00", "Bondi")
    assert (got[2].host_id, got[2].price, got[2].neighbourhood_cleansed) == (11, "150", "Manly")
    assert got[2].calendar_last_scraped is None                       # column absent from that file
    assert got[3].price is None and got[3].neighbourhood_cleansed is None  # NA token and blank
    assert "summary" not in df.columns
    assert got[1].filename.endswith("2020-01-01.csv") and got[3].filename.endswith("2020-03-01.csv.gz")


def test_bad_number_is_null(spark, scratch):
    root = local_dir(scratch("csv"))
    write(root, "2020-01-01.csv", "id,host_id,accommodates\n1,10,two\n")
    r = read_snapshots(spark, root).first()
    assert r.accommodates is None and r.id == 1


def test_lookup_csv_by_name(spark, scratch):
    root = local_dir(scratch("loc"))
    write(root, "location_lga.csv", "LGA_CODE,LOCALITY_NAME,LOCALITY_ID,LOCALITY_TYPE,POSTCODE,STATE,LGA_NAME\n"
                                    "L1,Bondi,7,SUBURB,2026,NSW,Waverley\n")
    r = read_lookup_csv(spark, root, LOCATION_SCHEMA).first()
    assert (r.LOCALITY_NAME, r.LGA_CODE, r.POSTCODE) == ("Bondi", "L1", "2026")


def test_parse_header_quotes():
    assert parse_header('﻿id,"host, name",x') == ("id", "host, name", "x")


def test_single_line_mode_reads_same_rows(spark, scratch):
    root = local_dir(scratch("csv"))
    write(root, "2020-01-01.csv", "id,host_id,price\n1,10,\"$1,250.00\"\n2,11,$5.00\n")
    a = sorted(tuple(r) for r in read_snapshots(spark, root).select("id", "price").collect())
    b = sorted(tuple(r) for r in read_snapshots(spark, root, multi_line=False).select("id", "price").collect())
    assert a == b == [(1, "$1,250.00"), (2, "$5.00")]


def test_stray_quote_and_line_breaks(spark, scratch):
    root = local_dir(scratch("csv"))
    write(root, "2020-01-01.csv", 'id,host_id,description\n1,10,5" pipe\n2,10,"a\nb"\n3,11," pad "\n4,11,"say ""hi"""\n')
    got = {r.id: r.description for r in read_snapshots(spark, root).collect()}
    assert got == {1: '5" pipe', 2: "a\nb", 3: " pad ", 4: 'say "hi"'}


def test_unknown_names_raise_and_upper_case_is_read(spark, scratch):
    root = local_dir(scratch("csv"))
    write(root, "2020-01-01.CSV", "id,host_id\n1,10\n")
    assert [r.id for r in read_snapshots(spark, root).collect()] == [1]
    write(root, "2020-02-01.txt", "id,host_id\n2,10\n")
    with pytest.raises(ValueError, match="2020-02-01.txt"):
        read_snapshots(spark, root)


def test_gzip_without_csv_in_its_name(spark, scratch):
    root = local_dir(scratch("csv"))
    write(root, "listings0.gz", "id,host_id\n1,10\n", gz=True)
    assert [r.id for r in read_snapshots(spark, root).collect()] == [1]


def test_lineage_is_spelled_as_the_listing(spark, scratch):
    root = local_dir(scratch("my in")) + "/a+b %20"
    write(root, "2020-01-01.csv", "id,host_id\n1,10\n")
    assert [r.filename for r in read_snapshots(spark, root).collect()] == list_files(spark, root)


def test_empty_file_is_skipped(spark, scratch):
    root = local_dir(scratch("csv"))
    write(root, "2020-01-01.csv", "id,host_id\n1,10\n")
    write(root, "2020-02-01.csv", "")
    assert [r.id for r in read_snapshots(spark, root).collect()] == [1]


def test_lineage_wins_over_a_filename_column_in_the_file(spark, scratch):
    root = local_dir(scratch("csv"))
    write(root, "2020-01-01.csv", "id,filename,host_id\n1,elsewhere.csv,10\n")
    rows = read_snapshots(spark, root).collect()
    assert [r.filename.endswith("2020-01-01.csv") for r in rows] == [True]


def test_integer_columns_take_whole_decimals(spark, scratch):
    root = local_dir(scratch("csv"))
    write(root, "2020-01-01.csv", "id,host_id,beds,accommodates,latitude\n1,10,2.0,2.5,-33.9\n2,11,3,x,1e1\n")
    got = {r.id: (r.beds, r.accommodates, r.latitude) for r in read_snapshots(spark, root).collect()}
    assert got == {1: (2, None, -33.9), 2: (3, None, 10.0)}
