"""minekit: classic large-scale data mining as Spark DataFrame operators.

``sources``    text readers and writers for the supported file forms
``functions``  column expressions, skew-safe joins and shared storage
``operators``  single steps, each a function from DataFrame to DataFrame
``plans``      whole jobs built from the steps (loops, searches, models)
``checks``     registered queries over the test tables and their SQL twins
"""
