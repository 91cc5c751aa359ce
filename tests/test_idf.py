import os

import pytest
from compare import connect, differences

from __spark_entry__ import oracle_sql, queries

#: More than 300 records a country, so that the sample and the whole corpus differ.
SF = os.environ.get("TEST_IDF_DIR", "/root/testdata/sf0.01")


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs a table larger than the sample")
def test_idf_is_of_the_whole_corpus(spark):
    whole, sampled = (queries()[name](spark, SF) for name in ("idf", "idf_sampled"))
    con = connect(SF)
    assert not differences(whole, con, oracle_sql()["idf"])
    assert not differences(sampled, con, oracle_sql()["idf_sampled"])
    terms = {(r.cc, r.term): r.idf for r in queries()["vocabulary"](spark, SF).selectExpr("cc", "term", "0 AS idf").collect()}
    got, part = ({(r.cc, r.term): r.idf for r in x.collect()} for x in (whole, sampled))
    print("terms", len(got), "sampled", len(part))
    assert set(got) <= set(terms) and len(got) > len(part)
