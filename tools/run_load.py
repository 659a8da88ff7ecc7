"""spark-submit launcher for the command-line load (see ``python -m ledgerloom --help``):

    spark-submit --py-files ledgerloom.zip tools/run_load.py --orders … --people … --returns … --base …
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerloom.__main__ import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(main())
