"""`python -m parquill`"""

import sys

from parquill.cli import main

sys.exit(main())
