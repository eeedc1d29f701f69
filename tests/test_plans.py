from kiln.operators.profile import profile
from kiln.plans.rules import (contract_dict, derive_policy, plan_cleaning, policy_dict, problem_type,
                              thresholds)


def test_policy_and_contract(spark):
    rows = [(i, i % 5, ("x" if i % 2 else "y") if i % 10 else None, float(i % 7) ** 3 if i % 9 else None, "k", 10.0 + (i % 3))
            for i in range(1, 201)]
    df = spark.createDataFrame(rows, "row_id long, CustomerID long, seg string, skewed double, konst string, level double")
    prof = profile(df)
    pol = policy_dict(derive_policy(prof))
    assert pol["subject_id"] == "CustomerID"
    assert "row_id" in pol["technical_garbage"] and "konst" in pol["technical_garbage"]
    c = contract_dict(plan_cleaning(prof, derive_policy(prof)))
    assert c["subject_id"] == "CustomerID"
    assert "row_id" in c["drop_features"] and "konst" in c["drop_features"]
    assert "CustomerID" not in c["drop_features"]
    assert c["imputation"]["categorical"] == ["seg"] and c["encoding"]["one_hot"] == ["seg"]
    assert "skewed" in c["imputation"]["median"] or "skewed" in c["imputation"]["mean"]
    assert c["scaling"]["standard"] == ["level"]


def test_thresholds():
    assert thresholds(51)["vif_threshold"] == 5.0
    assert thresholds(14)["pps_threshold"] == 0.005
    assert thresholds(15)["vif_threshold"] == 10.0
    assert thresholds(15, strong_features=16) == {"pps_threshold": 0.001, "vif_threshold": 25.0,
                                                   "initial": (0.02, 10.0)}


def test_problem_type_boundary(spark):
    df20 = spark.createDataFrame([(i % 20,) for i in range(100)], "y long")
    df21 = spark.createDataFrame([(i % 21,) for i in range(100)], "y long")
    assert problem_type(df20, "y", "gold") == "classification"
    assert problem_type(df21, "y", "gold") == "regression"
    assert problem_type(df20, "y", "silver") == "regression"


def test_preserve_on_flagged():
    assert thresholds(20, preserve_on_flagged=True, n_flagged=17, n_features=20)["vif_threshold"] == 25.0
    assert thresholds(20, preserve_on_flagged=True, n_flagged=2, n_features=20)["vif_threshold"] == 10.0
    assert thresholds(20, preserve_on_flagged=True, n_flagged=2, n_features=11)["vif_threshold"] == 25.0


def test_validate_strategy_and_gold_plan(spark):
    from kiln.plans.rules import plan_gold, validate_strategy
    rows = [(i, i % 7, float(i % 5), float(i % 3)) for i in range(100)]
    prof = profile(spark.createDataFrame(rows, "row_id long, CustomerID long, a double, b double"))
    bad = {"subject_id": "row_id", "interaction_priorities": [
        {"pair": ["a", "zz"], "logic": "division", "name": "x"}] * 16}
    errs = validate_strategy(bad, prof)
    assert any("logic" in e for e in errs) and any("unknown column zz" in e for e in errs)
    assert any("1:1" in e for e in errs) and any("PCA" in e for e in errs)
    good = {"interaction_priorities": [{"pair": ["a", "b"], "logic": "ratio", "name": "a_per_b"}],
            "feature_selection": {"max_correlation_threshold": 0.9}}
    assert validate_strategy(good, prof) == []
    gp = plan_gold(prof, {"subject_id": "CustomerID"}, good)
    assert gp["subject_id"] == "CustomerID" and "CustomerID" not in gp["base_metrics"]
    assert gp["selection_params"] == {"correlation_threshold": 0.9, "variance_threshold": 0.01,
                                      "force_keep": ["a_per_b"]}
    assert gp["preprocessing"]["scaler"] == "PowerTransformer" and gp["recommended_algorithm"] == "KMeans"


def test_a_later_interaction_may_use_an_earlier_one(spark):
    from kiln.operators.profile import profile
    from kiln.plans.rules import validate_strategy
    prof = profile(spark.createDataFrame([(1.0, 2.0), (3.0, 5.0)], "a double, b double"), with_mad=False)
    made = {"pair": ["a", "b"], "logic": "ratio", "name": "a_per_b"}
    later = {"pair": ["a_per_b", "a"], "logic": "multiplication", "name": "more"}
    assert validate_strategy({"interaction_priorities": [made, later]}, prof) == []
    assert validate_strategy({"interaction_priorities": [later, made]}, prof) == ["interaction more: unknown column a_per_b"]


def test_entity_key_and_trimmed_names(spark):
    from kiln.functions.names import as_entity
    from kiln.plans.supervised import generate_features
    df = spark.createDataFrame([(0, 5.0, "x"), (1, 7.0, "y")], "`Unnamed: 0` int, v double, Key string")
    assert as_entity(df, "key").columns == ["Key", "v"] and as_entity(df, None).columns == ["v", "Key"]
    wide = spark.createDataFrame([(1.0, 2.0, 1), (3.0, 4.0, 0)], "` a ` double, b double, ` y` int")
    assert generate_features(wide, carry=[" y"]).columns == ["a", "b", "a_minus_b", "a_ratio_b", "y"]


def test_gold_fits_read_held_silver(spark, monkeypatch):
    from kiln.plans import supervised as S
    from kiln.session import reads_cache
    seen, real = [], S.fit_robust_scale
    monkeypatch.setattr(S, "fit_robust_scale", lambda df, cols: seen.append(reads_cache(df)) or real(df, cols))
    silver = spark.createDataFrame([(i, float(i), "ab"[i % 2], i % 3) for i in range(9)], "k int, v double, c string, y int")
    out, _ = S.gold_features(silver, {"selected_features": ["v", "c"], "base_columns": ["v", "c"], "target_column": "y", "target_exists": True}, order_by="k")
    assert seen == [True] and not reads_cache(silver) and out.count() == 9


def test_supervised_clean_runs_every_step(spark, tmp_path, monkeypatch):
    import __spark_entry__ as E
    from kiln.operators import model_select as M
    scored, real = [], M.predictive_power
    monkeypatch.setattr(M, "predictive_power", lambda df, feats, target, **kw: scored.append((list(feats), target)) or real(df, feats, target, **kw))
    docs, labels = [], []
    for i in range(300):                           # quality follows the number of words only
        words = 1 + i % 30
        docs.append((i, " ".join(["w"] * words), "en" if i % 2 else "de", "ab"[i // 150], i * 37 % 101))
        labels.append((i, (i * 7919 >> 3) % 2, int(words > 15) if i else 1))    # document 0 disagrees with its copies
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    out = E.queries()["supervised_clean"](spark, str(tmp_path))
    assert scored == [(["n_chars", "n_words", "lang", "source", "toxic"], "quality")]
    assert out.columns == ["n_words", "lang", "source", "quality"]              # n_chars and toxic tell nothing
    seen = {(t.count("w"), lang, source, q) for (_, t, lang, source, _), (_, _, q) in zip(docs, labels)}
    told = {}
    for *key, q in seen:
        told.setdefault(tuple(key), set()).add(q)
    assert sorted(tuple(r) for r in out.collect()) == sorted(r for r in seen if len(told[r[:3]]) == 1)
    assert len(seen) - out.count() == 2


def test_few_levels_are_broadcast(spark, monkeypatch):
    from kiln.operators import encode as E
    df = spark.createDataFrame([(i, "cab"[i % 3] if i % 5 else None) for i in range(20)], "k int, c string")
    plan = lambda out: out._jdf.queryExecution().optimizedPlan().toString()
    few = E.factorize(df, ["c"], "k", suffix="_code")
    assert "strategy=broadcast" in plan(few)
    monkeypatch.setattr(E, "BROADCAST_LEVELS", 2)
    many = E.factorize(df, ["c"], "k", suffix="_code")
    assert "strategy=broadcast" not in plan(many)
    assert sorted(few.collect()) == sorted(many.collect()) and few.where("k = 1").first()["c_code"] == 0
