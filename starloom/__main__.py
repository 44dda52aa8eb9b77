"""``spark-submit`` entry: python -m starloom RAW_DIR WAREHOUSE_DIR [--lenient] [table=file ...]"""

import sys

from starloom.build import main

if __name__ == "__main__":
    if len(sys.argv) < 3:
        raise SystemExit(__doc__)
    lenient, *files = "--lenient" in sys.argv, *[a for a in sys.argv[3:] if a != "--lenient"]
    names = dict(pair.split("=", 1) for pair in files)
    main(sys.argv[1], sys.argv[2], names, strict=not lenient)
