"""tillroll: retail customer analytics as Spark DataFrame operators.

Every operator is a function from DataFrames to a DataFrame.  Start from
``tillroll.sources`` (read invoice lines), clean them with
``tillroll.operators.cleaning`` and feed the result to the other operators, or
run the whole batch with ``tillroll.plans.build``.
"""
