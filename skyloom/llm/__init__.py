"""Training-data operators.  Nothing outside this folder imports it."""

from pyspark import cloudpickle

import skyloom.llm as _self

# Workers of a cluster need not have the package installed: its functions
# travel with the tasks.
cloudpickle.register_pickle_by_value(_self)
