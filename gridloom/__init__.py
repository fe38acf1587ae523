"""Labelled-array analytics as Spark jobs.

Load fixed-length records and labelled CSV, validate, profile, normalise,
index, add and multiply sparse vectors as tables, and train and evaluate
classifiers by distributed gradients. DataFrame in, DataFrame out.
"""
