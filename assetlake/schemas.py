"""Target tables: columns, upsert keys and insert-only columns."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "bool": T.BooleanType(),
    "time": T.TimestampNTZType(),
    "json": T.VariantType(),
}


@dataclass(frozen=True)
class Table:
    """A target table; ``ddl`` lists its columns as ``name[:type]``, string by default.

    ``json`` columns are kept parsed, since child tables are derived from them; they are JSON text
    to a reader who does not ask for nodes.

    ``insert_only`` columns keep the value of the first insert when a key comes again.
    ``slice_by`` names the column by which whole slices of the table are replaced; a table
    that is upserted instead lies in buckets of its first key column (``bucketed``).
    """

    name: str
    ddl: str
    keys: tuple[str, ...] = ()
    insert_only: tuple[str, ...] = ()
    slice_by: str | None = None
    bucketed: bool = False
    columns: tuple[str, ...] = field(init=False)
    schema: T.StructType = field(init=False)

    def __post_init__(self):
        pairs = [c.partition(":")[::2] for c in self.ddl.split()]
        object.__setattr__(self, "columns", tuple(n for n, _ in pairs))
        object.__setattr__(
            self, "schema", T.StructType([T.StructField(n, _TYPES[t or "string"]) for n, t in pairs])
        )


_STAMPS = "Dt_Inserted:time Dt_updated:time"
_CODES = "CodOnda CodProcess"

# The key lists of the task parameter table, in column order.
PARAMETER_TEXTS = ["id", "name", "type", "label", "sourceConnectionId"]
PARAMETER_OBJECTS = [
    "uiProperties",
    "srcFFAttrs",
    "customFuncCfg",
    "targetRefsV2",
    "extendedObject",
    "runtimeAttrs",
    "tgtObjectAttributes",
    "runtimeParameterData",
]
PARAMETER_LISTS = ["targetUpdateColumns", "overridableProperties", "overriddenFields"]
PARAMETER_FLAGS = [
    "newFlatFile",
    "newObject",
    "showBusinessNames",
    "naturalOrder",
    "truncateTarget",
    "bulkApiDBTarget",
    "isRESTModernSource",
    "isFileList",
    "handleSpecialChars",
    "handleDecimalRoundOff",
    "frsAsset",
    "dynamicFileName",
    "excludeDynamicFileNameField",
    "currentlyProcessedFileName",
    "retainFieldMetadata",
    "useExactSrcNames",
]

# Table and column names, in table order.
TABLES = {
    t.name: t
    for t in [
        Table(
            "transformation_file_records",
            "id:long name type size:long updated_time:time updated_time_brazil:time " + _CODES,
            keys=("id",),
            insert_only=("CodOnda", "CodProcess"),
        ),
        Table(
            "transformation_file_records_hist",
            "id:long CodOnda CodProcess name type size:long "
            "updated_time:time updated_time_brazil:time",
            keys=("id",),
            insert_only=("CodOnda", "CodProcess"),
        ),
        Table(
            "connections",
            "id name description runtimeEnvironmentId instanceDisplayName host database_name "
            "codepage authenticationType adjustedJdbcHostName schema_name shortDescription type "
            "port password username majorUpdateTime:time majorUpdateTime_brazil:time timeout "
            "connParams internal:bool federatedId retryNetworkError:bool "
            "supportsCCIMultiGroup:bool metadataBrowsable:bool supportLabels:bool "
            "vaultEnabled:bool vaultEnabledParams",
            keys=("id",),
        ),
        Table(
            "content",
            "id class CodOnda CodProcess annotations big_int_convert_type document_type "
            "eco_system name template_origin links transformations:json variables " + _STAMPS,
            keys=("id",),
            insert_only=("CodOnda", "CodProcess", "Dt_Inserted"),
        ),
        Table(
            "transformation",
            "id class annotations create_time:time create_time_brazil:time name inputSorted "
            "advanced_properties:json _groups session_properties:json generate_filename_port:bool "
            "use_labels:bool use_sequence_fields:bool fields data_adapter:json content_name "
            + _CODES + " " + _STAMPS,
            keys=("id", "CodOnda", "CodProcess"),
            insert_only=("Dt_Inserted",),
            slice_by="CodOnda",
        ),
        Table(
            "transformation_session_properties",
            "id id_transf class name value content_name " + _CODES + " " + _STAMPS,
            keys=("id", "id_transf", "name", "CodOnda", "CodProcess"),
            insert_only=("Dt_Inserted",),
            slice_by="CodOnda",
        ),
        Table(
            "transformation_advanced_properties",
            "Id id_transf " + _CODES + " class name value content_name " + _STAMPS,
            keys=("Id", "id_transf", "CodOnda", "CodProcess"),
            insert_only=("Dt_Inserted",),
            slice_by="CodOnda",
        ),
        Table(
            "transformation_data_adapter",
            "id id_transf _class compatible_engine connection_id "
            "exclude_dynamic_file_name_field fw_config_id multiple_object object_type "
            "type_system use_dynamic_file_name object:json opr_runtime_attributes read_options "
            "runtime_attributes content_name " + _CODES + " " + _STAMPS,
            keys=("id", "id_transf", "CodOnda", "CodProcess"),
            insert_only=("Dt_Inserted",),
            slice_by="CodOnda",
        ),
        Table(
            "transformation_data_adapter_object",
            "id id_transf id_data_adapter " + _CODES + " class:int name custom_query label "
            "object_name object_type parent_path path retain_metadata fields file_attrs "
            "content_name " + _STAMPS,
            keys=("id", "id_transf", "id_data_adapter", "CodOnda", "CodProcess"),
            insert_only=("Dt_Inserted",),
            slice_by="CodOnda",
        ),
        Table(
            "AnomalyInsightTable",
            "CodOnda InconsistencyCode:int Note ProcessName ObjectType CodProcess DateIns:time",
            keys=("CodOnda", "InconsistencyCode", "Note", "ProcessName", "ObjectType", "CodProcess"),
        ),
        Table(
            "s_task",
            _CODES + " name parameters:json sessionPropertiesList:json Dt_Inserted:time Dt_Updated:time",
            keys=("name",),
            insert_only=("CodOnda", "CodProcess", "Dt_Inserted"),
        ),
        Table(
            "s_task_sessionPropertiesList",
            _CODES + " task_name name value recommended:int Dt_Inserted:time Dt_Updated:time",
        ),
        Table(
            "s_task_parameters",
            _CODES + " task_name id name type label uiProperties sourceConnectionId "
            "newFlatFile:int newObject:int showBusinessNames:int naturalOrder:int "
            "truncateTarget:int bulkApiDBTarget:int srcFFAttrs customFuncCfg targetRefsV2 "
            "targetUpdateColumns extendedObject runtimeAttrs isRESTModernSource:int "
            "isFileList:int handleSpecialChars:int handleDecimalRoundOff:int frsAsset:int "
            "dynamicFileName:int excludeDynamicFileNameField:int "
            "currentlyProcessedFileName:int retainFieldMetadata:int useExactSrcNames:int "
            "tgtObjectAttributes runtimeParameterData overridableProperties overriddenFields "
            + _STAMPS,
        ),
        Table(
            "exported_objects",
            "object_guid object_name object_type path description content_type document_state "
            "additional_info_json cod_projeto cod_processo created_at:time",
            slice_by="cod_projeto",
        ),
        Table(
            "ContentsofExportPackage",
            "id CodOnda:int CodProcess:int objectPath objectName objectType " + _STAMPS,
            keys=("id",),
            insert_only=("CodOnda", "CodProcess", "objectType", "Dt_Inserted"),
        ),
        Table(
            "Item",
            "EntryId Name MimeType Description AppliesTo Tags VersionLabel State ProcessGroup "
            "CreatedBy CreationDate:time ModifiedBy ModificationDate:time PublicationStatus "
            "PublishedBy PublicationDate:time PublishedContributionId GUID DisplayName "
            "CurrentServerDateTime:time",
            keys=("EntryId",),
        ),
        Table(
            "Entry",
            "EntryId DisplayName EntryName OverrideAPIName:int Description Tags Generator",
            keys=("EntryId",),
        ),
        Table("TempFields", "EntryId Description Name Type Options", keys=("EntryId", "Name")),
        Table(
            "Deployment",
            "EntryId SkipIfRunning:int SuspendOnFault:int TracingLevel AllowedGroups",
            keys=("EntryId",),
        ),
        Table("Flow", "EntryId FlowId StartId StartTargetId", keys=("EntryId",)),
        Table(
            "Service",
            "EntryId ServiceId Title ServiceName ServiceGUID",
            keys=("EntryId", "ServiceId"),
        ),
        Table(
            "ServiceInput",
            "EntryId ServiceId ParameterName Source Value",
            keys=("EntryId", "ServiceId", "ParameterName"),
        ),
        Table(
            "ServiceOperation",
            "EntryId ServiceId ParameterName OperationSource OperationTarget Value",
            keys=("EntryId", "ServiceId", "ParameterName", "OperationSource", "OperationTarget"),
        ),
        Table(
            "ServiceOutput",
            "EntryId ServiceId OperationSource OperationTarget Value",
            keys=("EntryId", "ServiceId", "OperationSource", "OperationTarget"),
        ),
        Table("Dependencies", "EntryId ProcessObject", keys=("EntryId", "ProcessObject")),
    ]
}
TABLES["transformation_hist"] = Table("transformation_hist", TABLES["transformation"].ddl)

TASKFLOW_TABLES = [
    "Item",
    "Entry",
    "TempFields",
    "Deployment",
    "Flow",
    "Service",
    "ServiceInput",
    "ServiceOperation",
    "ServiceOutput",
    "Dependencies",
]

# Tables that the loads upsert; all others are replaced, by slices or as a whole.
_UPSERTED = ["content", "connections", "s_task", "transformation_file_records_hist", "ContentsofExportPackage"]
for _name in [*_UPSERTED, *TASKFLOW_TABLES]:
    TABLES[_name] = replace(TABLES[_name], bucketed=True)
