"""No operator here keeps stream state: the reference work is batch only.

The row-wise steps (typing, features, labels, scoring with a fitted model) are plain column
expressions, so ``readStream`` tables pass through them unchanged; measures of a stream are
recomputed from its written predictions.
"""
