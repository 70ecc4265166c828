"""Time registered queries once warm: python tools/timing.py SF_DIR [name ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import session  # noqa: E402


def main(sf_dir, names):
    spark = session()
    from varloom.plans import suite

    spent = {}
    for name in names or suite.QUERIES:
        start = time.time()
        try:
            suite.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            spent[name] = time.time() - start
        except Exception as error:  # noqa: BLE001
            print("FAIL", name, str(error)[:300], flush=True)
    for name, seconds in sorted(spent.items(), key=lambda x: -x[1]):
        print(f"{seconds:7.1f} {name}", flush=True)
    print(f"{sum(spent.values()):7.1f} total")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
