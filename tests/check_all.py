"""Run every registered query against its SQL: ``python tests/check_all.py FOLDER [NAME ...]``."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from backglance.session import local_session  # noqa: E402
from tests.oracle import connect, difference  # noqa: E402

if __name__ == "__main__":
    folder, names = sys.argv[1], sys.argv[2:]
    spark = local_session(int(os.environ.get("CORES", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    connection, sqls, bad = connect(folder), entry.oracle_sql(), []
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            frame = run(spark, folder)
            if name in sqls:
                wrong = difference(frame, connection, sqls[name])
                state = wrong or "same"
            else:
                rows = frame.collect()
                wrong, state = None, f"{len(rows)} rows {rows[:3]}"
        except Exception as error:  # report and go on with the next query
            wrong = state = f"{type(error).__name__} {str(error)[:600]}"
        bad += [name] if wrong else []
        print(f"{name:28s} {time.time() - start:6.2f} s  {state}", flush=True)
    print("wrong:", bad)
