"""The whole way from pages to a graph over a small invented text, with a stub in the model's place: nothing leaves the machine."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import catalog, models
from corpusloom.operators.state import TableStore
from corpusloom.plans import jobs
from corpusloom.sources.files import units_of_texts

TEXT = """---[p 1]---
كتاب العلم
باب طلب العلم
1- قال زرارة العقل نور والعلم ضياء في القلوب الطاهرة
---[p 2]---
ومن طلب العلم نال الخير الكثير
2- قال محمد العقل حجة الله على العباد في الدنيا والاخرة
---[p 3]---
3- الصلاة عمود الدين وهي معراج المؤمن كل يوم وليلة
"""


def answer(prompt: str) -> str:
    """Mentions of a few known words; every pair supports."""
    if prompt.startswith("A:"):
        return json.dumps({"relation": "SUPPORTS"})
    words = [w for w in ("العقل", "الصلاة", "العلم") if w in prompt]
    return json.dumps({"mentions": [{"text": w, "type": "concept", "salience": 0.9, "evidence": ""} for w in words], "ravis": ["زرارة"] if "زرارة" in prompt else [], "quran_refs": ["2:3"] if "الصلاة" in prompt else []}, ensure_ascii=False)


def run(spark: SparkSession, store: TableStore) -> dict[str, int]:
    """Counts of what each step made. The graph lies below the store's folder."""
    units = units_of_texts(spark.createDataFrame([("demo.txt", TEXT)], "path string, content string"))
    new = jobs.ingest_units(store, units, "demo", "hadith").count()
    backend = models.StubBackend(answer)
    jobs.extract(store, backend)
    forms = catalog.concept_forms(spark.createDataFrame([("العقل", "العقل", None, 0), ("العلم", "العلم", None, 1)], "id string, pref string, aliases array<string>, ord int"))
    entities = catalog.entity_forms(catalog.entity_table(spark, []))
    nodes = jobs.resolve(store, forms, entities).first()["nodes"]
    jobs.embed(store, lambda texts: [[float(len(t)), 1.0] for t in texts])
    pairs = jobs.link(store, backend).count()
    _, edges = jobs.export_store(store, f"{store.root}/graph")
    return {"chunks": new, "nodes": nodes, "pairs": pairs, "edges": edges.count(), "cites": edges.where(F.col("kind") == "CITES").count()}
