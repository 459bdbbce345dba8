"""The class tree and properties of the asset model as triples, and which class an object is of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Each class with those right below it.
TREE = {
    "BIMEntity": ["BIMObject", "AnalysisArtifact"],
    "BIMObject": ["PhysicalObject", "Container"],
    "PhysicalObject": ["PipingComponent", "StructuralMember", "Equipment", "ElectricalComponent", "HvacComponent", "UncategorizedObject"],
    "Equipment": ["ProcessEquipment", "ElectricalEquipment", "ArchitecturalEquipment", "HvacEquipment", "CivilElements", "CivilEquipment", "BlackBoxSystems", "UnclassifiedEquipment"],
    "Container": ["HierarchyNode"],
    "AnalysisArtifact": ["AnalysisVolume"],
    "Context": ["Pipeline", "PipeRun", "Level", "ConnectedGroup", "Material", "Specification"],
}
#: Classes by refined class, and of equipment by its first type.
BY_CLASS = {"Piping": "PipingComponent", "Structure": "StructuralMember", "Electrical": "ElectricalComponent", "HVAC": "HvacComponent"}
BY_TYPE = {"Process Equipment": "ProcessEquipment", "Electrical Equipment": "ElectricalEquipment", "Architectural": "ArchitecturalEquipment", "HVAC Equipment": "HvacEquipment", "Civil Elements": "CivilElements", "Civil Equipment": "CivilEquipment", "Black Box Systems": "BlackBoxSystems"}
#: Links between things, from and to which class; of them the symmetric ones.
LINKS = {
    "adjacentTo": ("PhysicalObject", "PhysicalObject"), "hasParent": ("BIMEntity", "BIMEntity"), "belongsToPipeline": ("PipingComponent", "Pipeline"), "belongsToPipeRun": ("PipingComponent", "PipeRun"),
    "hasMaterial": ("PhysicalObject", "Material"), "hasSpecification": ("PhysicalObject", "Specification"), "atLevel": ("BIMEntity", "Level"), "inGroup": ("BIMEntity", "ConnectedGroup"),
}
SYMMETRIC = ("adjacentTo",)
#: Literals by class and type.
LITERALS = {
    ("BIMEntity", "string"): ["objectId", "displayName", "systemPath", "refinedClass", "classificationConfidence", "classificationConfidenceReason"],
    ("BIMEntity", "integer"): ["level", "vertexCount", "triangleCount"],
    ("BIMEntity", "double"): ["centroidX", "centroidY", "centroidZ", "bboxVolumeM3", "distanceM", "overlapVolumeM3"],
    ("BIMEntity", "boolean"): ["hasRealMesh", "isContainer", "isAnalysisVolume"],
    ("PhysicalObject", "double"): ["dryWeightKg", "wetWeightKg", "lengthM", "designPressureKpa", "designTemperatureC"],
    ("PipingComponent", "string"): ["commodityCode", "npd", "specName"],
    ("ConnectedGroup", "boolean"): ["isGiantGroup"],
    ("Pipeline", "string"): ["pipelineName"], ("PipeRun", "string"): ["pipeRunName"], ("Level", "integer"): ["levelValue"],
    ("Material", "string"): ["materialName"], ("Specification", "string"): ["specificationName"],
}


def schema_triples(spark: SparkSession) -> DataFrame:
    """(s, p, o) of all classes, subclass links, and properties with their domains and ranges."""
    below = {c: top for top, own in TREE.items() for c in own}
    rows = []
    for c in [*[t for t in TREE if t not in below], *below]:
        rows += [(f"bim:{c}", "rdf:type", "owl:Class"), (f"bim:{c}", "rdfs:label", c)]
        rows += [(f"bim:{c}", "rdfs:subClassOf", f"bim:{below[c]}")] if c in below else []
    properties = [(name, "owl:ObjectProperty", a, f"bim:{b}") for name, (a, b) in LINKS.items()]
    properties += [(name, "owl:DatatypeProperty", a, f"xsd:{kind}") for (a, kind), own in LITERALS.items() for name in own]
    for name, kind, domain, reach in properties:
        rows += [(f"bim:{name}", "rdf:type", kind), (f"bim:{name}", "rdfs:label", name), (f"bim:{name}", "rdfs:domain", f"bim:{domain}"), (f"bim:{name}", "rdfs:range", reach)]
    rows += [(f"bim:{name}", "rdf:type", "owl:SymmetricProperty") for name in SYMMETRIC]
    return spark.createDataFrame(rows, "s string, p string, o string")


def class_of(volume: Column, container: Column, parent_box: Column, refined: Column, first_type: Column) -> Column:
    """A volume, else a node of the hierarchy (containers and parent boxes), else by refined class; equipment by its type."""

    def pick(of: Column, names: dict[str, str], default: str) -> Column:
        return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), of), F.lit(default))

    equipment = pick(first_type, BY_TYPE, "UnclassifiedEquipment")
    no = F.lit(False)
    made = F.when(F.coalesce(volume, no), "AnalysisVolume").when(F.coalesce(container, no) | F.coalesce(parent_box, no), "HierarchyNode")
    return made.when(refined == "Equipment", equipment).otherwise(pick(refined, BY_CLASS, "UncategorizedObject"))
