"""Compare every derived table between Spark and the checking engine."""
import sys, time
sys.path.insert(0, __import__("os").path.dirname(__import__("os").path.dirname(__import__("os").path.abspath(__file__))))
import duckdb
from haulmark.session import local_session
from haulmark.sources.testbed import TABLES, TestBed, check_sql_of, SOURCES
from tools.compare import compare
d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
spark = local_session(8)
spark.sparkContext.setLogLevel("ERROR")
bed = TestBed(spark, d)
con = duckdb.connect()
for s in SOURCES:
    con.execute(f"create view {s} as select * from '{d}/{s}.parquet'")
for n in TABLES:
    try:
        print(n, compare(bed[n], con, check_sql_of(n)))
    except Exception as e:
        print(n, "ERROR", str(e)[:400])
