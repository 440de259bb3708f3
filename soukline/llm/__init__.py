"""Training-data operators: dedup, mixing, formatting, quality, scoring, tokens, URLs.

One module per operator; ``queries`` registers them. Worker functions are shipped by
value, so executors need no copy of this package.
"""

from pyspark import cloudpickle as _cloudpickle

import soukline.llm as _self

_cloudpickle.register_pickle_by_value(_self)
