from threading import Barrier

from curbline.operators.models import MODEL_KINDS
from curbline.plans import modelling
from curbline.session import copy_folder, scratch_path


def test_models_of_the_suite_are_fitted_side_by_side(spark, monkeypatch):
    met = Barrier(len(MODEL_KINDS))

    def waits(kind):
        def fit(*_, **__):
            met.wait(20)  # breaks unless all are under way
            return kind
        return fit

    monkeypatch.setattr(modelling.models, "fit_mean", waits("baseline"))
    monkeypatch.setattr(modelling.models, "fit_linear", waits("linear"))
    monkeypatch.setattr(modelling.knn, "fit_knn", waits("knn"))
    monkeypatch.setattr(modelling, "fit_forest", waits("random_forest"))
    monkeypatch.setattr(modelling.models, "fit_trees", waits("boosting"))
    assert modelling.train_suite(spark.range(10)) == {kind: kind for kind in MODEL_KINDS}


def test_a_copied_folder_replaces_the_target(spark):
    source, target = scratch_path(spark, "source"), scratch_path(spark, "target")
    spark.range(3).write.parquet(f"{source}/a")
    spark.range(9).write.parquet(f"{target}/a")
    spark.range(9).write.parquet(f"{target}/b")
    copy_folder(spark, source, target)
    assert spark.read.parquet(f"{target}/a").count() == 3
    left = [p.getName() for p in _listed(spark, target)]
    assert left == ["a"]


def _listed(spark, path):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [s.getPath() for s in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]
