"""Fixed values that the SQL oracles expect, written out apart from the library.

A changed byte of the library's own constant makes its query differ from these.
"""

INSTRUCTION_HEAD = '        ### Instruction:\n        '  # noqa: E501
PREAMBLE = 'Below are some instructions that describe some tasks. Write responses that appropriately complete each request.'  # noqa: E501
RESPONSE_HEAD = '        ### Response:\n        '  # noqa: E501
TURN_GLUE = '\n\n'  # noqa: E501
ANSWER_PROMPT = '\nYour task is to answer the question based on the given context.\nGeneration Guidelines:\n1. Use the same language as the context.\n2. Only use provided context to generate answer, do not make up any information.\n3. If the question is not related to the context, just return "No information found".\n4. Must provide as much information as possible from the context to answer the question.\n5. Answer must follow the following order: first cite the relevant context in the <reference> tag, then make inferences and finally give the answer in the <answer> tag.\n<context>\n{context}\n</context>\n<question>\n{question}\n</question>\n'  # noqa: E501
QUESTION_PROMPT = '\nYou are a teacher, you task is to generate questions for your students based on the given context.\nGeneration Guidelines:\n1. Generate questions diverse and cover different aspects of the context.\n2. Use the same language as the context.\n3. Only use provided context to generate questions, do not make up any information.\n<context>\n{context}\n</context>\nGenerate {target_num} questions.\nUse `,` to separate each question.\nOnly Return the questions, no other text.\n'  # noqa: E501
DEFAULT_VLM_INSTRUCTION = 'Describe the image in detail.'  # noqa: E501
VENDOR_SYSTEM_PROMPT = "This is a chat between a user and an artificial intelligence assistant. The assistant gives helpful, detailed, and polite answers to the user's questions based on the context. The assistant should also indicate when the answer cannot be found in the context."  # noqa: E501
PLAIN_SEPARATORS = ['。', '，', '！', '？', '；', '：', ' ', '\n\n', '\n', '. ', '? ', '! ', '; ', ', ', ' ']
PLAIN_SEPS = ['。', '，', '！', '？', '；', '：', ' ', '\n\n', '\n']  # those of them that can win
