"""Clustering and anomaly detection on delimited records, as Spark DataFrame jobs.

    lines -> typed fields -> feature arrays -> (one-hot, PCA, z-score) -> K-means
          -> cluster quality, cluster/label counts, anomalies -> text files

The same steps run per micro-batch on a Structured Streaming source.
"""

__version__ = "0.1.0"
