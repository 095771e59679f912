"""Classic machine learning on Spark DataFrames.

Every pass over the data is a DataFrame projection or aggregate.  Only model
parameters and a bounded number of statistics reach the driver.
"""
