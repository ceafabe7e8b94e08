"""lectern: labelled-text analytics as Spark DataFrame operators.

Every operator takes and returns a DataFrame. Relational work is expressed
with the DataFrame / SQL API so Catalyst and adaptive execution choose the
physical plan; Python runs only inside Arrow-batched pandas UDFs.
"""

__version__ = "0.1.0"
