"""Prompt templates filled as column expressions.

Templates are plain strings with ``{name}`` slots; ``fill`` cuts a template at its slots and joins the
pieces with columns by native ``concat``, so a whole table of prompts is built without leaving the JVM.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------
# Prompt texts that must equal the reference's, whitespace included.
SIMPLE_PROMPT = (
    "You are an AI language model assistant. Your task is to generate a cohesive and concise response "
    "to the user question.\n"
    "    Question: {question}\n"
    "    "
)
RAG_PROMPT = (
    " You are a specialist in cryptocurrency content writing. Your task is to create articles based on "
    "a user query given a specific context \n"
    "    with additional information consisting of the user's previous writings and his knowledge.\n"
    "    \n"
    "    Here is a list of steps that you need to follow in order to solve this task:\n"
    "    Step 1: You need to analyze the user provided query : {question}\n"
    "    Step 2: You need to analyze the provided context and how the information in it relates to the "
    "user question: {context}\n"
    "    Step 3: Generate the content keeping in mind that it needs to be as cohesive and concise as "
    "possible related to the subject presented in the query and similar to the users writing style and "
    "knowledge presented in the context.\n"
    "    "
)
DATASET_USER_PROMPT = (
    "I will give you batches of contents of articles. Please generate me exactly 1 instruction for each "
    "of them. The article for which you have to generate the instructions is under Content number x lines. "
    "Please structure the answer in json format,ready to be loaded by json.loads(), a list of objects only "
    "with fields called instruction and content. For the content field, copy the number of the content "
    "only!.Please do not add any extra characters and make sure it is a list with objects in valid json "
    "format!\n"
)
DATASET_COUNT_LINE = ("You must generate exactly a list of {n} json objects, using the contents provided "
                      "under CONTENTS FOR GENERATION\n")
DATASET_CONTENTS_HEADER = "\nCONTENTS FOR GENERATION: \n"
DATASET_ITEM = "Content number {i}\n{content}\n"
EXPANSION_PROMPT = (
    "You are an AI language model assistant. Your task is to generate {n_expansions}\n"
    "    different versions of the given user question to retrieve relevant documents from a vector\n"
    "    database. By generating multiple perspectives on the user question, your goal is to help\n"
    "    the user overcome some of the limitations of the distance-based similarity search.\n"
    "    Provide these alternative questions seperated by '{separator}'.\n"
    "    Original question: {question}"
)
QUESTION_SEPARATOR = "#next-question#"
RERANK_PROMPT = (
    "You are an AI language model assistant. Your task is to rerank passages related to a query\n"
    "    based on their relevance. \n"
    "    The most relevant passages should be put at the beginning. \n"
    "    You should only pick at max {keep_top_k} passages.\n"
    "    The provided and reranked documents are separated by '{separator}'.\n"
    "    \n"
    "    The following are passages related to this query: {question}.\n"
    "    \n"
    "    Passages: \n"
    "    {passages}\n"
    "    "
)
PASSAGE_SEPARATOR = "\n#next-document#\n"
QA_PROMPT = (
    "You are an AI language model assistant whose job is to provide answers to cryptocurrency investors\n"
    "    in order to make informed decisions based on news. If the user query is a question, provide answers "
    "based on the given context only if it is relevant.\n"
    "    If the user query is not a question, just give a summary of the relevant content in the context "
    "related to the query. \n"
    "    USER_QUERY:\n"
    "    ```{user_query}```\n"
    "    CONTEXT:\n"
    "    {context}"
)
EVALUATION_PROMPT = (
    "\n"
    "        You are an AI assistant and your task is to evaluate the output generated by another LLM.\n"
    "        You need to follow these steps:\n"
    "        Step 1: Analyze the user query: {query}\n"
    "        Step 2: Analyze the response: {output}\n"
    "        Step 3: Evaluate the generated response based on the following criteria and provide a score from "
    "1 to 5 along with a brief justification for each criterion:\n"
    "\n"
    "        Evaluation:\n"
    "        Relevance - [score]\n"
    "        [1 sentence justification why relevance = score]\n"
    "        Coherence - [score]\n"
    "        [1 sentence justification why coherence = score]\n"
    "        Conciseness - [score]\n"
    "        [1 sentence justification why conciseness = score]\n"
)
INSTRUCT_SAMPLE = "<s>[INST]{instruction}\n        [/INST] {content}</s>"


def _parts(template: str, names) -> list[str]:
    """The template cut at its slots: text, slot, text, slot, ..., text."""
    return re.split("(" + "|".join(re.escape("{" + n + "}") for n in names) + ")", template)


def fill(template: str, **slots: Column) -> Column:
    """Slots are filled in one pass: a value that itself holds ``{name}`` stays as it is."""
    return F.concat(*[F.coalesce(slots[p[1:-1]].cast("string"), F.lit("")) if k % 2 else F.lit(p)
                      for k, p in enumerate(_parts(template, slots))])


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def fill_sql(template: str, **slots: str) -> str:
    return "(" + " || ".join(f"coalesce(CAST({slots[p[1:-1]]} AS VARCHAR), '')" if k % 2 else _q(p)
                             for k, p in enumerate(_parts(template, slots))) + ")"
