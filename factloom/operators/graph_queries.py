"""The analytical queries over a graph, one function for each statement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.graph import Graph
from factloom.operators.closure import closure, settle

REGISTRATION_TYPES = ("SERVICE_REGISTRATION", "BINDER_SERVICE_NAME", "LOCAL_SERVICE_KEY")
REGISTRATION_EDGES = ("REGISTERS_BINDER_NAME", "REGISTERS_LOCAL_KEY", "REGISTERS_INSTANCE", "REGISTERED_AS", "EXPOSED_AS_LOCAL_SERVICE")


def endpoints(graph: Graph, *edge_types: str) -> DataFrame:
    """Edges of the types with both ends' nodes as structs ``source`` and ``target``."""
    node = lambda n: graph.nodes.select(F.col("node_id").alias(f"_{n}"), F.struct("node_id", "node_type", "qualified_name", "source_path", "line_start").alias(n))
    edges = graph.links(*edge_types) if edge_types else graph.edges
    return edges.select("edge_type", "from_node_id", "to_node_id").join(node("source"), F.col("from_node_id") == F.col("_source")).join(node("target"), F.col("to_node_id") == F.col("_target")).drop("_source", "_target")


def binder_of(graph: Graph, implementation: str) -> DataFrame:
    """The interfaces that one class implements."""
    found = endpoints(graph, "IMPLEMENTS_BINDER").where(F.col("source.qualified_name") == implementation)
    return found.select(F.col("source.qualified_name").alias("implementation"), F.col("target.qualified_name").alias("binder_interface"), F.col("target.source_path").alias("aidl_file"))


def implementations_of(graph: Graph, interface: str) -> DataFrame:
    """The classes that implement one interface, by name."""
    found = endpoints(graph, "IMPLEMENTS_BINDER").where(F.col("target.qualified_name") == interface)
    return found.select(F.col("source.qualified_name").alias("implementation"), F.col("target.qualified_name").alias("binder_interface"), F.col("source.source_path").alias("source_path")).orderBy("implementation")


def _places(graph: Graph, key_edge: str, keys: DataFrame | None = None) -> DataFrame:
    """(impl, key, source_path, line_start) of every registration, by the key and the instance that it has; of some ``keys`` (key, ...) with their columns.

    Joined by the registration, which has few of either, so that keys of many registrations multiply no rows.
    """
    by_key = graph.links(key_edge).select(F.col("from_node_id").alias("registration"), F.col("to_node_id").alias("key"))
    by_key = by_key if keys is None else by_key.join(keys, "key")
    by_instance = graph.links("REGISTERS_INSTANCE").select(F.col("from_node_id").alias("registration"), F.col("to_node_id").alias("impl"))
    places = graph.of_type("SERVICE_REGISTRATION").select(F.col("node_id").alias("registration"), "source_path", "line_start")
    return by_key.join(by_instance, "registration").join(places, "registration").drop("registration")


def _registrations(graph: Graph, link: str, key_edge: str, keys: Column) -> DataFrame:
    """(impl, key) ids and names, and places, where one registration has both the key and the instance of a link.

    Written from the selective end: the keys, then their registrations, then the links by the composite key.
    """
    key_nodes = graph.nodes.where(keys).select(F.col("node_id").alias("key"), F.col("qualified_name").alias("key_name"))
    impls = graph.nodes.select(F.col("node_id").alias("impl"), F.col("qualified_name").alias("implementation"))
    registered = graph.links(link).select(F.col("from_node_id").alias("impl"), F.col("to_node_id").alias("key"))
    return _places(graph, key_edge, key_nodes).join(registered, ["impl", "key"]).join(impls, "impl")


def service_chain(graph: Graph, service: str | None = None) -> DataFrame:
    """Services with their implementation, its interface if it has one, and where they are registered."""
    chain = _registrations(graph, "REGISTERED_AS", "REGISTERS_BINDER_NAME", F.col("qualified_name") == service if service is not None else F.lit(True))
    binder = graph.links("IMPLEMENTS_BINDER").select(F.col("from_node_id").alias("impl"), F.col("to_node_id").alias("aidl"))
    aidl = graph.nodes.select(F.col("node_id").alias("aidl"), F.col("qualified_name").alias("binder_interface"))
    full = chain.join(binder, "impl", "left").join(aidl, "aidl", "left")
    return full.select(F.col("key_name").alias("service_name"), "implementation", "binder_interface", "source_path", "line_start").distinct().orderBy("implementation", "source_path", "line_start", "binder_interface")


def transitive_binder(graph: Graph, implementation: str | None = None, guard: str = "exact", inheritance: DataFrame | None = None) -> DataFrame:
    """Interfaces that a class implements through an ancestor, with the depth of that ancestor."""
    walked = inheritance if inheritance is not None else closure(graph.links("EXTENDS"), guard=guard)
    names = lambda a, b: graph.nodes.select(F.col("node_id").alias(a), F.col("qualified_name").alias(b))
    binder = graph.links("IMPLEMENTS_BINDER").select(F.col("from_node_id").alias("ancestor_id"), F.col("to_node_id").alias("aidl"))
    impl = names("class_id", "implementation")
    impl = impl.where(F.col("implementation") == implementation) if implementation is not None else impl
    full = walked.join(impl, "class_id").join(binder, "ancestor_id").join(names("ancestor_id", "binder_base"), "ancestor_id").join(names("aidl", "binder_interface"), "aidl")
    return full.select("implementation", "binder_base", "binder_interface", "depth").distinct().orderBy("depth", "implementation", "binder_base", "binder_interface")


def inherited_service_chain(graph: Graph, service: str | None = None, guard: str = "exact") -> DataFrame:
    """Registered services whose implementation gets its interface from an ancestor (depth 1 or more).

    Ancestors meet their interfaces and names before the registrations, which are many and move once, by implementation.
    """
    chain = _registrations(graph, "REGISTERED_AS", "REGISTERS_BINDER_NAME", F.col("qualified_name") == service if service is not None else F.lit(True))
    names = lambda a, b: graph.nodes.select(F.col("node_id").alias(a), F.col("qualified_name").alias(b))
    binder = graph.links("IMPLEMENTS_BINDER").select(F.col("from_node_id").alias("ancestor_id"), F.col("to_node_id").alias("aidl"))
    interfaces = binder.join(names("aidl", "binder_interface"), "aidl").join(names("ancestor_id", "binder_base"), "ancestor_id")
    starts = None
    if service is not None:  # the walks of one service's classes are few
        chain = settle(chain)
        starts = chain.select("impl")
    walked = closure(graph.links("EXTENDS"), guard=guard, starts=starts).withColumnRenamed("class_id", "impl")
    full = chain.join(walked.join(interfaces, "ancestor_id").select("impl", "binder_base", "binder_interface", "depth"), "impl")
    return full.select(F.col("key_name").alias("service_name"), "implementation", "binder_base", "binder_interface", "depth", "source_path", "line_start").distinct().orderBy("depth", "implementation", "source_path", "line_start", "service_name", "binder_base", "binder_interface")


def local_services(graph: Graph, limit: int | None = 100, parity: bool = False) -> DataFrame:
    """Local services with their implementation and where they are registered, by key and implementation.

    The default ties a registration to both its key and its instance; an exposed
    service without one has no place. ``parity`` pairs every exposed service with
    every registration, which is what joining registrations by type alone gives.
    Under a limit only the first exposed services can come out, so only those
    meet the registrations; without a limit that form is refused.
    """
    names = lambda a, b: graph.nodes.select(F.col("node_id").alias(a), F.col("qualified_name").alias(b))
    exposed = graph.links("EXPOSED_AS_LOCAL_SERVICE").select(F.col("from_node_id").alias("impl"), F.col("to_node_id").alias("key")).join(names("impl", "implementation"), "impl").join(names("key", "local_service_key"), "key")
    order = ["local_service_key", "implementation", "source_path", "line_start"]
    if parity:
        if limit is None:
            raise ValueError("parity needs a limit")
        first = exposed.select("local_service_key", "implementation").orderBy("local_service_key", "implementation").limit(limit)
        # Each of these rows meets the same registrations: the first ``limit`` of them are enough.
        places = graph.of_type("SERVICE_REGISTRATION").select("source_path", "line_start").orderBy("source_path", "line_start").limit(limit)
        return first.join(F.broadcast(places), F.lit(True), "left").select(*order).orderBy(*order).limit(limit)
    found = exposed.join(_places(graph, "REGISTERS_LOCAL_KEY"), ["impl", "key"], "left")
    out = found.select(*order).orderBy(*order)
    return out.limit(limit) if limit is not None else out


def type_counts(graph: Graph, edges: bool = False, only: tuple[str, ...] | None = None) -> DataFrame:
    """Rows of each node or edge type, the largest first; of some types by name."""
    df, col = (graph.edges, "edge_type") if edges else (graph.nodes, "node_type")
    counted = (df.where(F.col(col).isin(*only)) if only else df).groupBy(col).agg(F.count("*").alias("count"))
    return counted.orderBy(col) if only else counted.orderBy(F.desc("count"), col)


def property_counts(graph: Graph, node_type: str, key: str) -> DataFrame:
    """Nodes of a type by a property; those without it count under null."""
    value = F.get_json_object("properties_json", f"$.{key}").alias(key)
    return graph.of_type(node_type).groupBy(value).agg(F.count("*").alias("count")).orderBy(F.desc("count"), key)


def coverage(graph: Graph) -> DataFrame:
    """Nodes by repository and type, where the repository is known."""
    located = graph.nodes.select(F.get_json_object("properties_json", "$.repository").alias("repository"), "node_type").where("repository is not null")
    return located.groupBy("repository", "node_type").agg(F.count("*").alias("count")).orderBy("repository", F.desc("count"), "node_type")


def with_prefix(graph: Graph, prefix: str) -> DataFrame:
    """Edges whose source path starts with the prefix."""
    return graph.edges.where(F.col("source_path").startswith(prefix))
