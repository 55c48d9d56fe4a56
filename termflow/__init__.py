"""termflow: text-classification analytics on Spark DataFrames.

Corpus lines -> parsed documents -> tokens -> top-K dictionary -> sparse
term-frequency rows -> variance feature selection -> classifiers
(relational batch gradient descent, Spark ML logistic regression and
linear SVM) -> confusion matrices and metric reports.
"""

__version__ = "0.1.0"
