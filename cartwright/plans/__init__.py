"""Business reports. Each is a function of DataFrames that returns a DataFrame.

Money and quantities are exact decimals and integers; ratios are doubles. The
text that the printed reports show is added by ``plans.reports``.
"""
