"""Column contracts of the tables the package reads and writes."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, StringType, StructField, StructType

# Header names of the transaction feed, with the types they are read as.
TRANSACTION_TYPES = {
    "InvoiceNo": "string",
    "StockCode": "string",
    "Description": "string",
    "Quantity": "int",
    "InvoiceDate": "string",
    "UnitPrice": "double",
    "CustomerID": "string",
    "Country": "string",
}
TRANSACTION_COLUMNS = tuple(TRANSACTION_TYPES)

MESSAGE = StructType([StructField("role", StringType()), StructField("content", StringType())])
CHAT_ROW = StructType([StructField("messages", ArrayType(MESSAGE))])
