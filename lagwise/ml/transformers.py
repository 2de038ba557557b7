"""Two persistable MLlib transformers built from column expressions."""
from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagwise import fixed_values as fv
from lagwise.functions.columns import corrected_probability


class TokenEncoder(Transformer, HasInputCols, HasOutputCols,
                   DefaultParamsReadable, DefaultParamsWritable):
    """Every input column as text, with an explicit token where it is NULL."""

    token = Param(Params._dummy(), "token", "text that stands for NULL",
                  typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, token=fv.UNKNOWN_TOKEN):
        super().__init__()
        self._setDefault(token=fv.UNKNOWN_TOKEN)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        inputs = self.getInputCols()
        outputs = self.getOutputCols() if self.isDefined("outputCols") \
            else [f"{c}_cat" for c in inputs]
        token = F.lit(self.getOrDefault(self.token))
        return dataset.withColumns({
            out: F.coalesce(F.col(c).cast("string"), token) for c, out in zip(inputs, outputs)})


class PriorCorrector(Transformer, HasInputCol, HasOutputCol,
                     DefaultParamsReadable, DefaultParamsWritable):
    """Brings a probability learnt on undersampled negatives back to the real prevalence.

    The input is MLlib's probability vector or a plain number. ``oddsFactor`` states the factor for
    the odds directly, for models whose odds were changed in another way; it may exceed one.
    """

    keptRate = Param(Params._dummy(), "keptRate", "share of negatives kept, in (0, 1]",
                     typeConverter=TypeConverters.toFloat)

    oddsFactor = Param(Params._dummy(), "oddsFactor", "factor for the odds, above 0",
                       typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol="probability", outputCol="p_calibrated", keptRate=1.0,
                 oddsFactor=None):
        super().__init__()
        self._setDefault(inputCol="probability", outputCol="p_calibrated", keptRate=1.0)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _factor(self) -> float:
        if self.isSet(self.oddsFactor):
            factor = self.getOrDefault(self.oddsFactor)
            if not factor > 0:
                raise ValueError(f"oddsFactor is above 0, got {factor}")
            return factor
        rate = self.getOrDefault(self.keptRate)
        if not 0 < rate <= 1:
            raise ValueError(f"keptRate lies in (0, 1], got {rate}")
        return rate

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rate, source = self._factor(), self.getInputCol()
        is_vector = isinstance(dataset.schema[source].dataType, VectorUDT)
        sampled = vector_to_array(source)[1] if is_vector else F.col(source).cast("double")
        return dataset.withColumn(self.getOutputCol(), corrected_probability(sampled, rate))
