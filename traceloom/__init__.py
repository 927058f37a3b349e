"""traceloom: evidence discovery and identity linkage as Spark DataFrame plans.

The core holds sources, functions, operators, plans and streaming. The
subpackage ``llm`` holds operators for training-data pipelines; nothing in the
core imports it.
"""

__version__ = "0.1.0"
