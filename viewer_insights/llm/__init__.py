"""Training-data operators: decontamination, quality rules, secret scans, URL
filters, WARC fixity, chat formatting, near-dedup, sharding, packing and a
quality classifier.  Nothing else in the library imports this subpackage.

Python code that runs inside tasks is shipped by value, so executors need not
have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
