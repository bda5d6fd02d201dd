"""spark-submit entry for one scheduled batch run: ``spark-submit wxrun.py LANDING TABLE OUT``
(ship the package with ``--py-files`` on a cluster)."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wxspark.plans.run import main  # noqa: E402

if __name__ == "__main__":
    raise SystemExit(main())
