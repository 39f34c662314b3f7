"""The land-cover steps as pipeline stages that can be saved and loaded."""

from __future__ import annotations

from math import ceil

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelframe.functions.indices import add_indices
from pixelframe.operators.catalog import PATH_COLUMNS, unpack_paths
from pixelframe.operators.features import assemble
from pixelframe.operators.labels import recode_labels
from pixelframe.operators.pixels import explode_pixels, flatten_struct
from pixelframe.schemas import LABEL, PIXEL_BANDS, PIXEL_ORDER
from pixelframe.sources.files import band_paths_by_listing, band_paths_by_name
from pixelframe.sources.rasters import ERROR, FIRST_PIXEL, decode_patches
from pixelframe.sources.tables import read_label_dictionary


BAND_PATHS = {"list": band_paths_by_listing, "name": band_paths_by_name}


class _Stage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A transformer whose settings are Params, so that pipelines can be saved."""

    def _set_given(self, given: dict) -> None:
        self._set(**{k: v for k, v in given.items() if v is not None})


def _strings(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc, TypeConverters.toListString)


class PixelExtractor(_Stage):
    """Catalogue rows to one row per patch with a ``pixel_arrays`` struct.

    A raster above the decoder's block size comes in several rows; the
    struct's ``first_pixel`` says where in the patch the arrays of a row begin.

    ``find`` says how band files are found: ``list`` lists each patch's
    directories, ``name`` builds the paths from the naming rule. The patches
    are spread over ``tasks`` decode tasks first; 0 counts them and gives each
    task ``patchesPerTask``. A patch that cannot be decoded is one row without pixels, with the
    reason in the struct's ``error``; ``stage_rejects`` selects these.

    With ``bundle`` the three directories come from that array of paths, and
    ``scheme`` is put back in front of them; such paths can only be listed.
    """

    keys = _strings("keys", "catalogue columns carried along")
    find = Param(Params._dummy(), "find", "list or name", TypeConverters.toString)
    tasks = Param(Params._dummy(), "tasks", "decode tasks", TypeConverters.toInt)
    patchesPerTask = Param(Params._dummy(), "patchesPerTask", "patches of a decode task", TypeConverters.toInt)
    bundle = Param(Params._dummy(), "bundle", "path bundle column", TypeConverters.toString)
    scheme = Param(Params._dummy(), "scheme", "scheme of bundled paths", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, keys=None, find=None, tasks=None, patchesPerTask=None, bundle=None, scheme=None):
        super().__init__()
        self._setDefault(
            keys=["patch_id", "split"], find="list", tasks=0, patchesPerTask=512, bundle="", scheme="s3://"
        )
        self._set_given(self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        keys, tasks = self.getOrDefault("keys"), self.getOrDefault("tasks")
        find, bundle = BAND_PATHS[self.getOrDefault("find")], self.getOrDefault("bundle")
        if bundle:
            scheme = F.lit(self.getOrDefault("scheme"))
            df = unpack_paths(df, PATH_COLUMNS, bundle)
            df = df.withColumns({c: F.concat(scheme, c) for c in PATH_COLUMNS})
        tasks = tasks or max(1, ceil(df.count() / self.getOrDefault("patchesPerTask")))
        paths = find(df.repartition(tasks), keys)
        arrays = F.struct(*PIXEL_BANDS, FIRST_PIXEL, ERROR).alias("pixel_arrays")
        return decode_patches(paths, keys).select(*keys, arrays)


def stage_rejects(extracted: DataFrame) -> DataFrame:
    """Patches that ``PixelExtractor`` could not decode, with the reason in ``error``."""
    error = F.col(f"pixel_arrays.{ERROR}")
    return extracted.where(error.isNotNull()).withColumn(ERROR, error).drop("pixel_arrays")


class PixelExploder(_Stage):
    """``pixel_arrays`` to one row per pixel."""

    keep = _strings("keep", "patch columns repeated for each pixel")

    @keyword_only
    def __init__(self, *, keep=None):
        super().__init__()
        self._setDefault(keep=[])
        self._set_given(self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        keep = self.getOrDefault("keep")
        arrays = flatten_struct(df, "pixel_arrays", PIXEL_BANDS, keep)
        return explode_pixels(arrays, keep=keep).select(*keep, *PIXEL_ORDER)


class IndexBuilder(_Stage):
    """Adds the eight band-math indices."""

    standardNdwi = Param(
        Params._dummy(), "standardNdwi", "published form of NDWI", TypeConverters.toBoolean
    )

    @keyword_only
    def __init__(self, *, standardNdwi=None):
        super().__init__()
        self._setDefault(standardNdwi=False)
        self._set_given(self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return add_indices(df, standard_ndwi=self.getOrDefault("standardNdwi"))


class LabelRecoder(_Stage):
    """Replaces the label by its code in the dictionary CSV at ``path``."""

    path = Param(Params._dummy(), "path", "dictionary CSV", TypeConverters.toString)
    dropUnlabeled = Param(
        Params._dummy(), "dropUnlabeled", "leave out unlabeled pixels", TypeConverters.toBoolean
    )

    @keyword_only
    def __init__(self, *, path=None, dropUnlabeled=None):
        super().__init__()
        self._setDefault(dropUnlabeled=False)
        self._set_given(self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        dictionary = read_label_dictionary(df.sparkSession, self.getOrDefault("path"))
        return recode_labels(
            df, dictionary, drop_unlabeled=self.getOrDefault("dropUnlabeled")
        )


class FeatureAssembler(_Stage):
    """All columns but the label, ``exclude`` and ``keep`` to ``features``."""

    exclude = _strings("exclude", "columns that are no features")
    keep = _strings("keep", "columns carried along beside the features")

    @keyword_only
    def __init__(self, *, exclude=None, keep=None):
        super().__init__()
        self._setDefault(exclude=[], keep=[])
        self._set_given(self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return assemble(df, LABEL, self.getOrDefault("exclude"), self.getOrDefault("keep"))
