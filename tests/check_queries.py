"""Command-line form of the comparison: ``python tests/check_queries.py SF_DIR [name-prefix ...]``."""

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from millrace import catalog  # noqa: E402
from millrace.session import local_session  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402


def main() -> int:
    root, prefixes = sys.argv[1], sys.argv[2:]
    names = [n for n in catalog.load() if not prefixes or n.startswith(tuple(prefixes))]
    spark, con = local_session(), connect(root)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problems = compare(spark, con, root, name)
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:500]}"]
            if "-v" in sys.argv:
                traceback.print_exc()
        took = time.time() - start
        if problems:
            bad += 1
            print(f"BAD  {name} {took:.2f}s", *problems, sep="\n     ", flush=True)
        elif took > 2:
            print(f"ok   {name} {took:.2f}s", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
