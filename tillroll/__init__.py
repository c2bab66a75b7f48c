"""tillroll: retail sales analytics on Spark DataFrames.

Build or load the star once (:func:`tillroll.plans.star.load_star`), then
call any report in :mod:`tillroll.plans` with it; every report returns a
lazy DataFrame.  See README.md for the design.
"""
