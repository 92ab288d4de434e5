"""Principal components, centred and with a fixed sign."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import PCA, ElementwiseProduct, PCAModel, StandardScaler, StandardScalerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame

from trendspark.session import c


@dataclass(frozen=True)
class CentredPCA:
    """Spark's PCA centres while fitting but not while projecting; here both do.

    The largest loading of every component is made positive.
    """

    centre: StandardScalerModel
    model: PCAModel
    signs: ElementwiseProduct
    k: int

    @classmethod
    def fit(cls, train: DataFrame, vec: str, k: int = 100) -> CentredPCA:
        raw = train.select(array_to_vector(c(vec).cast("array<double>")).alias("_raw"))
        centre = StandardScaler(inputCol="_raw", outputCol="_centred", withMean=True, withStd=False).fit(raw)
        model = PCA(k=k, inputCol="_centred", outputCol="_pc").fit(centre.transform(raw))
        loadings = model.pc.toArray()
        top = np.abs(loadings).argmax(0)
        signs = np.where(loadings[top, np.arange(loadings.shape[1])] < 0, -1.0, 1.0)
        flip = ElementwiseProduct(inputCol="_pc", outputCol="_signed", scalingVec=Vectors.dense(signs))
        return cls(centre, model, flip, k)

    def apply(self, df: DataFrame, vec: str, out: str | None = None) -> DataFrame:
        """Columns pca_0.. (or one array column ``out``) in place of ``vec``."""
        raw = df.withColumn("_raw", array_to_vector(c(vec).cast("array<double>")))
        done = self.signs.transform(self.model.transform(self.centre.transform(raw)))
        done = done.withColumn("_scores", vector_to_array("_signed")).drop(vec, "_raw", "_centred", "_pc", "_signed")
        if out:
            return done.withColumnRenamed("_scores", out)
        kept = [c(n) for n in done.columns if n != "_scores"]
        return done.select(*kept, *[c("_scores")[i].alias(f"pca_{i}") for i in range(self.k)])

    def explained_variance(self, df_or_spark) -> DataFrame:
        """(component, ratio, cumulative)."""
        spark = getattr(df_or_spark, "sparkSession", df_or_spark)
        ratios = [float(v) for v in self.model.explainedVariance.toArray()]
        total = np.cumsum(ratios)
        rows = [(i, r, float(t)) for i, (r, t) in enumerate(zip(ratios, total, strict=True))]
        return spark.createDataFrame(rows, "component int, ratio double, cumulative double")
